"""Sources: FASTQ, reference genome, native alignments and SAM text."""

from readloom.sources.alignments import parse_alignments, read_alignments, valid_alignments
from readloom.sources.fastq import number_records, read_fastq
from readloom.sources.fastq_ranges import read_fastq_ranges
from readloom.sources.reference import read_reference, reference_bases, reference_tiles
from readloom.sources.sam import parse_sam, read_sam, sam_header

__all__ = [
    "number_records",
    "parse_alignments",
    "parse_sam",
    "read_alignments",
    "read_fastq",
    "read_fastq_ranges",
    "read_reference",
    "read_sam",
    "reference_bases",
    "reference_tiles",
    "sam_header",
    "valid_alignments",
]
