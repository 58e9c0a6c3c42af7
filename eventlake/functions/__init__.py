"""Column expressions (built-in Spark functions only; all stay in codegen)."""

from .timecols import instant_to_utc_ntz, parse_event_time, utc_ntz_to_instant, utc_text
from .fingerprint import id_hash

__all__ = ["instant_to_utc_ntz", "parse_event_time", "utc_ntz_to_instant", "utc_text", "id_hash"]
