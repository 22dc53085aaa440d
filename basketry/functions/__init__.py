from basketry.functions.codes import normalize_code, pad_code
from basketry.functions.metrics import METRICS, number_text

__all__ = ["METRICS", "normalize_code", "number_text", "pad_code"]
