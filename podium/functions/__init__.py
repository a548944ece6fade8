"""Column expressions (all JVM-side, whole-stage-codegen friendly)."""

from podium.functions.text import (  # noqa: F401
    clean_text, coerce_number, season_of, half_even, format_number, trend_label,
    null_to_text, split_names, first_link, absolute_url, strip_tags, decode_entities,
)
from podium.functions.dates import (  # noqa: F401
    parse_event_dates, dates_to_iso, any_date_between, format_day,
)
from podium.functions.bands import threshold_band  # noqa: F401
