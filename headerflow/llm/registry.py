"""The queries of this subpackage, and SQL for those that SQL can express."""

from . import decontaminate, neardup, substring
from .bpe import op5_bpe
from .language import op1_language
from .media import op8_media
from .pitmanyor import op10_pitmanyor
from .quality import op9_quality
from .sharding import op3_sharding
from .wavelet import op7_wavelet


def queries():
    return {
        "op1_language": op1_language, "op2_neardup": neardup.op2_neardup, "op3_sharding": op3_sharding, "op4_substring": substring.op4_substring,
        "op5_bpe": op5_bpe, "op6_decontaminate": decontaminate.op6_decontaminate, "op7_wavelet": op7_wavelet, "op8_media": op8_media,
        "op9_quality": op9_quality, "op10_pitmanyor": op10_pitmanyor,
    }


def oracle_sql():
    return {"op2_neardup": neardup.ORACLE, "op4_substring": substring.ORACLE, "op6_decontaminate": decontaminate.ORACLE}
