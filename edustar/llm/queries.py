"""Registry of the training-data queries and their SQL (None where SQL can't express the method)."""

from __future__ import annotations

from .bpe import op7_bpe_transducer
from .common import ship
from .exact_dedup import OP9_SQL, op9_exact_dedup
from .fill_middle import OP13_SQL, op13_fill_middle
from .license_scan import OP5_SQL, op5_license_dice, op5_license_spans
from .line_dedup import OP11_SQL, op11_line_dedup
from .ngram_join import op10_ngram_jaccard
from .packing import op8_cost_packing
from .pii_crf import op4_pii_skip_chain
from .quality_fm import op1_quality_fm
from .spelling_fst import op12_spelling_fst
from .toxicity import op6_toxicity
from .vector_search import OP2_SQL, op2_block_join
from .warc import OP3_SQL, op3_warc_derivatives


def _shipped(fn):
    def run(spark, sf_dir):
        ship(spark)
        return fn(spark, sf_dir)
    return run


QUERIES = {f.__name__: _shipped(f) for f in (
    op1_quality_fm, op2_block_join, op3_warc_derivatives, op4_pii_skip_chain, op5_license_dice, op5_license_spans, op6_toxicity,
    op7_bpe_transducer, op8_cost_packing, op9_exact_dedup, op10_ngram_jaccard, op11_line_dedup, op12_spelling_fst, op13_fill_middle)}
ORACLE_SQL = {"op2_block_join": OP2_SQL, "op3_warc_derivatives": OP3_SQL, "op5_license_dice": OP5_SQL, "op9_exact_dedup": OP9_SQL,
              "op11_line_dedup": OP11_SQL, "op13_fill_middle": OP13_SQL}
