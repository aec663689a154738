"""Field normalisation: site date texts, signed numbers, karma, ISO times.

Site dates read like ``5 марта 2015 в 14:30``, ``сегодня в 10:15`` or
``вчера в 09:00``.  Month names are replaced by English abbreviations,
the relative words by the date of ``fetched_at`` (an input column, so the
result does not depend on when the job runs), then a fixed list of
patterns is tried with ``try_to_timestamp``; unparsable text gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the site date format.
MONTHS_GENITIVE = [
    "января", "февраля", "марта", "апреля", "мая", "июня",
    "июля", "августа", "сентября", "октября", "ноября", "декабря",
]
MONTHS_EN = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
AT_WORD = " в "
TODAY_WORD = "сегодня"
YESTERDAY_WORD = "вчера"
EN_DASH = "–"
INVITED_PHRASE = "по приглашению"
LAST_SEEN_PATTERN = r"Последний[^0-9]*на сайте"

# Patterns tried in order after the replacements.
DATE_PATTERNS = [
    "d MMM yyyy HH:mm",
    "yyyy-MM-dd HH:mm",
    "d MMM yyyy",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
]
# Patterns without a year: the year is taken from ``fetched_at``.
YEARLESS_PATTERNS = ["d MMM HH:mm", "d MMM"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _replace_months(s: Column) -> Column:
    for ru, en in zip(MONTHS_GENITIVE, MONTHS_EN):
        s = F.replace(s, F.lit(ru), F.lit(en))
    return s


def parse_site_datetime(text, fetched_at) -> Column:
    """Site date text → ``TIMESTAMP_NTZ`` (null when no pattern fits)."""
    fetched = _col(fetched_at)
    today = F.date_format(fetched, "yyyy-MM-dd")
    yesterday = F.date_format(F.date_sub(F.to_date(fetched), 1), "yyyy-MM-dd")
    s = _replace_months(_col(text))
    s = F.replace(s, F.lit(AT_WORD), F.lit(" "))
    # Relative words need the fetch time; without it the text stays as is.
    s = F.coalesce(F.replace(s, F.lit(TODAY_WORD), today), s)
    s = F.coalesce(F.replace(s, F.lit(YESTERDAY_WORD), yesterday), s)
    s = F.trim(s)
    tries = [F.try_to_timestamp(s, F.lit(p)) for p in DATE_PATTERNS]
    with_year = F.concat(s, F.lit(" "), F.year(fetched).cast("string"))
    tries += [F.try_to_timestamp(with_year, F.lit(p + " yyyy")) for p in YEARLESS_PATTERNS]
    return F.coalesce(*tries).cast("timestamp_ntz")


def render_site_datetime(ts, fetched_at) -> Column:
    """Inverse of :func:`parse_site_datetime`, minute precision, as the site
    shows it: relative words for the fetch day and the day before."""
    ts, fetched = _col(ts), _col(fetched_at)
    hm = F.date_format(ts, "HH:mm")
    day = F.to_date(ts)
    fday = F.to_date(fetched)
    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS_GENITIVE]), F.month(ts))
    full = F.concat_ws(" ", F.dayofmonth(ts).cast("string"), month, F.year(ts).cast("string"))
    return (F.when(day == fday, F.concat(F.lit(TODAY_WORD + AT_WORD), hm))
            .when(day == F.date_sub(fday, 1), F.concat(F.lit(YESTERDAY_WORD + AT_WORD), hm))
            .otherwise(F.concat(full, F.lit(AT_WORD), hm)))


def parse_int(text) -> Column:
    """``–5`` (en dash) → -5, ``+3`` → 3; bad text → null."""
    return F.replace(F.trim(_col(text)), F.lit(EN_DASH), F.lit("-")).try_cast("int")


def parse_number(text) -> Column:
    """En dash → minus, comma → dot, then DOUBLE; bad text → null."""
    s = F.replace(F.replace(F.trim(_col(text)), F.lit(EN_DASH), F.lit("-")), F.lit(","), F.lit("."))
    return s.try_cast("double")


def parse_karma(text, convert_en_dash: bool = True) -> Column:
    """Karma / rating text → DOUBLE.

    The profile parser of the original only turned commas into dots, so a
    negative written with an en dash became null; ``convert_en_dash=True``
    (the default) converts it like the post-page rating does.
    """
    if convert_en_dash:
        return parse_number(text)
    return F.replace(F.trim(_col(text)), F.lit(","), F.lit(".")).try_cast("double")


def render_number(x, en_dash: bool = True) -> Column:
    """Number as the site prints it: comma decimals, en-dash negatives."""
    s = F.replace(_col(x).cast("string"), F.lit("."), F.lit(","))
    return F.replace(s, F.lit("-"), F.lit(EN_DASH)) if en_dash else s


def iso(ts) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss")


def parse_iso(text) -> Column:
    """ISO text, with ``T`` or a space, with or without a fraction of a second."""
    t = F.regexp_replace(_col(text), "^([0-9]{4}-[0-9]{2}-[0-9]{2})T", "$1 ")
    fits = t.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,9})?$")
    return F.when(fits, t.try_cast("timestamp_ntz"))


def registration_text(text) -> Column:
    """Cut the text before the invitation phrase when it is not at 0."""
    t = _col(text)
    pos = F.locate(INVITED_PHRASE, t)  # 1-based, 0 when absent
    return F.when(pos > 1, F.substring(t, F.lit(1), pos - 1)).otherwise(t)


def last_activity_text(text) -> Column:
    return F.trim(F.regexp_replace(_col(text), LAST_SEEN_PATTERN, ""))


def strip_ws(text) -> Column:
    """Whitespace trimmed on both ends (spaces, tabs, newlines)."""
    return F.regexp_replace(_col(text), r"^\s+|\s+$", "")


def strip_label(text) -> Column:
    """``strip().rstrip(':')`` of a definition-list label."""
    return F.regexp_replace(strip_ws(text), ":+$", "")
