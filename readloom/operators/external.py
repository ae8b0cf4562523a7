"""Lines through a user's command: on its stdin, and back from its stdout."""

from __future__ import annotations

import shlex
import subprocess
import threading
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

ROWS = 4096


def command_lines(command: str, lines: Iterable[str]) -> Iterator[str]:
    """Lines that ``command`` prints for ``lines``; a failing command raises.

    A thread feeds the command while its output is read, so neither side is held as a whole.
    """
    with subprocess.Popen(shlex.split(command), stdin=subprocess.PIPE, stdout=subprocess.PIPE) as process:
        failed: list[BaseException] = []

        def feed() -> None:
            try:
                for line in lines:
                    process.stdin.write(line.encode() + b"\n")
                process.stdin.close()
            except BrokenPipeError:
                pass  # the command does not read all its input
            except BaseException as err:  # noqa: BLE001
                failed.append(err)
                process.kill()

        feeder = threading.Thread(target=feed)
        feeder.start()
        for line in process.stdout:
            yield line.decode().rstrip("\n")
        feeder.join()
        if failed:
            raise failed[0]
        if process.wait():
            raise RuntimeError(f"{command!r} ended with status {process.returncode}")


def line_batches(lines: Iterable[str]) -> Iterator[pa.RecordBatch]:
    held: list[str] = []
    for line in lines:
        held.append(line)
        if len(held) == ROWS:
            yield pa.record_batch([pa.array(held, pa.string())], names=["value"])
            held = []
    if held:
        yield pa.record_batch([pa.array(held, pa.string())], names=["value"])


def pipe_lines(df: DataFrame, command: str, column: str = "value", empty: bool = True) -> DataFrame:
    """``value`` lines that ``command`` prints; a failing command fails the task.

    One process per partition. With ``empty`` a partition without rows runs the command on no input, as
    the pipe of Spark does.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (line for batch in batches for line in batch.column(0).to_pylist())
        first = next(lines, None)
        if first is None and not empty:
            return
        rest = lines if first is None else _chain(first, lines)
        yield from line_batches(command_lines(command, rest))

    return df.select(column).mapInArrow(run, "value string")


def _chain(first: str, rest: Iterator[str]) -> Iterator[str]:
    yield first
    yield from rest
