"""Quotation linking on planted threads and on quoted conversation turns."""

from collections import defaultdict

from pyspark.sql import functions as F

from readloom.llm import quotes as Q


def test_levels():
    text = "> > deep\n>> deep two\n> near\nown > not\n\n  >x"
    assert Q.levels(text) == [(2, "deep"), (2, "deep two"), (1, "near"), (0, "own > not"), (0, ""), (1, "x")]


def test_threads(spark):
    rows = [
        (1, "Shall we meet?"), (2, "> shall  WE meet?\nYes."), (3, ">> Shall we meet?\n> Yes.\nGood."), (4, "> Yes.\nWhy?"),
        (5, "First.\n\nSecond part."), (6, "> Second part.\nAgreed."), (7, "> nobody said this\nHm."), (8, None), (8, ""), (9, "> \nempty"),
        (10, "> later words\nx"), (11, "later words"), (None, "> Yes.\nnull id"), (4, "> Yes.\nWhy?"),
        *((20 + i, "ok") for i in range(30)), *((100 + i, f"> ok\nfine {i}") for i in range(30)),
    ]
    messages = spark.createDataFrame([(i, t, 0, "z") for i, t in rows], "message_id long, text string, kind int, hash string").repartition(4)
    got = Q.conversations(messages).collect()
    assert len(got) == len(rows)
    by = {r.message_id: r for r in got}
    assert {i: by[i].parent_id for i in range(1, 12)} == {1: None, 2: 1, 3: 2, 4: 2, 5: None, 6: 5, 7: None, 8: None, 9: None, 10: None, 11: None}
    assert [(by[i].conversation_id, by[i].depth, by[i].own) for i in (1, 2, 3, 6)] == [(1, 0, "Shall we meet?"), (1, 1, "Yes."), (1, 2, "Good."), (5, 1, "Agreed.")]
    assert all(by[100 + i].parent_id == 20 for i in range(30))
    assert Q.conversations(messages.limit(0)).count() == 0


def test_long_chain(spark):
    rows = [(i, f"> line {i - 1}\nline {i}" if i else "line 0") for i in range(300)]
    got = Q.conversations(spark.createDataFrame(rows, "message_id long, text string")).collect()
    assert {(r.message_id, r.conversation_id, r.depth) for r in got} == {(i, 0, i) for i in range(300)}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append(r.text)
    first, want = {}, {}
    for conv, texts in turns.items():
        for k, t in enumerate(texts, 1):
            key = (Q.normal([t]), Q.normal([texts[k - 2]]) if k > 1 else "")
            first[key] = min(first.get(key, 1 << 62), conv * (1 << 20) + k)
    for conv, texts in turns.items():
        for k in range(2, len(texts) + 1):
            want[conv * (1 << 20) + k] = first[Q.normal([texts[k - 2]]), Q.normal([texts[k - 3]]) if k > 2 else ""]
    got = Q.op8_quotes(spark, sf).collect()
    assert len(got) == sum(map(len, turns.values()))
    assert {r.message_id: r.parent_id for r in got if r.parent_id is not None} == want


def test_long_conversation(spark):
    """A conversation of more turns than the width of an id has, over several ranges, and ids at the border of 64 bits."""
    rows = [(5, k, f"t{k}") for k in range(1, 41)] + [(6, k, f"u{k}") for k in range(1, 4)] + [(6, 3, "u3")] * 3 + [(1 << 50, 1, "v")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, text string").repartition(5)
    texts = defaultdict(list)
    for c, _, t in rows:
        texts[c].append(t)
    want = [(t, ts[k - 1] if k else None, ts[k - 2] if k > 1 else None) for ts in texts.values() for k, t in enumerate(ts)]
    for width in (3, 20):
        got = sorted(Q.numbered(turns, width).collect())
        assert [r.message_id for r in got] == list(range(1, 48)) and [tuple(r)[1:] for r in got] == want
    low = turns.where("conv_id < 7")
    got = sorted(Q.numbered(low, 6).collect())
    assert [r.message_id for r in got] == [5 * 64 + k for k in range(1, 41)] + [6 * 64 + k for k in range(1, 7)]
    assert [tuple(r)[1:] for r in got] == want[:46]
    assert Q.numbered(low.limit(0)).count() == 0


def test_deep_levels(spark):
    """A missing, edited or blank parent: the shallowest quote that hits links; earlier goes by time where given."""
    rows = [
        (1, 50, "Start."), (2, 60, ""), (3, 70, ">> Start.\n> \nGo on."), (4, 80, ">>> Start.\n>> gone\n> edited\nWell."),
        (5, 90, ">> Start.\n> Go on.\nBoth."), (6, 10, "Late id."), (0, 99, "> Late id.\nOld id."),
    ]
    messages = spark.createDataFrame(rows, "message_id long, at long, text string")
    by = lambda got: {r.message_id: (r.parent_id, r.level, r.conversation_id) for r in got.collect()}
    want = {1: (None, None, 1), 2: (None, None, 2), 3: (1, 2, 1), 4: (1, 3, 1), 5: (3, 1, 1), 6: (None, None, 6), 0: (None, None, 0)}
    assert by(Q.conversations(messages)) == want
    assert by(Q.conversations(messages, time_col="at")) == want | {0: (6, 1, 6)}


def test_turns_with_marks_and_without_conversation(spark, tmp_path):
    """Own lines that look like quotes come back whole, also where they are quoted; turns of no conversation stay."""
    own = [">>> x = 1\n  > y\nz", "\\> kept", "\\\\ >two\n> > three", ">", "plain", None]
    rows = [(1, k, t) for k, t in enumerate(own)] + [(None, 0, "> alone"), (None, None, "alone"), (None, 2, None), (2, None, "plain")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    escaped = [r.e for r in turns.where("conv_id = 1 and text is not null").select(Q.escape(F.col("text")).alias("e")).collect()]
    assert [Q.levels(e, True) for e in escaped] == [[(0, line) for line in t.split("\n")] for t in own[:-1]]
    turns.write.parquet(str(tmp_path / "conversations.parquet"))
    got = Q.op8_quotes(spark, str(tmp_path)).collect()
    width = 1 << Q.WIDTH
    links = {r.message_id: (r.parent_id, r.conversation_id, r.depth, r.own_chars) for r in got if r.message_id is not None}
    want = {width + k: (width + k - 1 if k > 1 else None, width + 1, k - 1, len((t or "").strip())) for k, t in enumerate(own, 1)}
    assert links == want | {2 * width + 1: (None, 2 * width + 1, 0, 5)}
    assert sorted(tuple(r)[1:] for r in got if r.message_id is None) == [(None, None, 0, 0), (None, None, 0, 5), (None, None, 0, 7)]
