"""Column functions: lenient casts, mixed-format dates, path decoding. All stay inside codegen."""

from daybook.functions.casts import lenient_cast
from daybook.functions.dates import date_parts, day_of, parse_mixed_date, period_start
from daybook.functions.paths import decode_path

__all__ = ["date_parts", "day_of", "decode_path", "lenient_cast", "parse_mixed_date", "period_start"]
