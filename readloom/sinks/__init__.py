"""Sinks: reports, paired FASTQ, locus counts and plain lines."""

from readloom.sinks.text import write_fastq, write_lines, write_locus_counts, write_paired_fastq, write_report

__all__ = ["write_fastq", "write_lines", "write_locus_counts", "write_paired_fastq", "write_report"]
