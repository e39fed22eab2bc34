"""Training-data operators: one module per operator, each with its query.

``REGISTRY`` maps query names to (builder, oracle SQL or None).  Nothing
outside this subpackage, ``corpus_pipeline.py`` and their tests imports it.
"""

from . import (  # noqa: F401
    ann_collision,
    bpe_lexicon,
    fingerprint_lcp,
    gnat_codes,
    hard_negatives,
    langid,
    license_scan,
    lm_hmm,
    mixing,
    neardup,
    packing,
    quality_gbt,
    warc,
)
from .common import REGISTRY  # noqa: F401
