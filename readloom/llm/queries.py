"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from readloom.llm import search, warc
from readloom.llm.bpe import op2_bpe
from readloom.llm.common import Query
from readloom.llm.fingerprints import op1_fingerprints
from readloom.llm.jaccard import op12_jaccard
from readloom.llm.mixing import op6_mixing
from readloom.llm.quality import op9_quality
from readloom.llm.quotes import op8_quotes
from readloom.llm.repeats import op10_repeats
from readloom.llm.search import op11_search
from readloom.llm.simhash import op5_simhash
from readloom.llm.token_counts import op4_token_counts
from readloom.llm.toxicity import op3_toxicity
from readloom.llm.warc import op7_warc
from readloom.llm.whitening import op13_whitening

QUERIES: dict[str, Query] = {run.__name__: run for run in [op1_fingerprints, op2_bpe, op3_toxicity, op4_token_counts, op5_simhash, op6_mixing, op7_warc, op8_quotes, op9_quality, op10_repeats, op11_search, op12_jaccard, op13_whitening]}
ORACLES: dict[str, str] = {"op7_warc": warc.ORACLE, "op11_search": search.ORACLE}
