"""End-to-end jobs."""

from readloom.plans.jobs import align_external, ngs, qc, qc_and_trim, sam_pileup, snp_counts, trim_pair

__all__ = ["align_external", "ngs", "qc", "qc_and_trim", "sam_pileup", "snp_counts", "trim_pair"]
