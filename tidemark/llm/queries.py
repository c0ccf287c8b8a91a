"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from .alignment import op12_alignment
from .decontamination import op4_decontamination
from .language_id import op8_language_id
from .licenses import op9_license_scan
from .line_dedup import OP2_SQL, op2_line_dedup
from .lm_scoring import op13_lm_scoring
from .neighbours import op10_nearest
from .ngram_jaccard import op1_ngram_jaccard
from .pii import op3_pii
from .quality import op5_quality
from .sentencepiece_codec import op6_sentencepiece
from .spelling import OP11_SQL, op11_spelling
from .toxicity import op7_toxicity

QUERIES = {
    "op10_nearest": op10_nearest,
    "op5_quality": op5_quality,
    "op3_pii": op3_pii,
    "op7_toxicity": op7_toxicity,
    "op2_line_dedup": op2_line_dedup,
    "op9_license_scan": op9_license_scan,
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op4_decontamination": op4_decontamination,
    "op6_sentencepiece": op6_sentencepiece,
    "op8_language_id": op8_language_id,
    "op11_spelling": op11_spelling,
    "op12_alignment": op12_alignment,
    "op13_lm_scoring": op13_lm_scoring,
}
ORACLE: dict[str, str] = {
    "op2_line_dedup": OP2_SQL,
    "op11_spelling": OP11_SQL,
}
