"""Days from dates as publishers write them. The day is that of the text, whatever zone it names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factloom.functions.urls import bind

# How the names of the months begin in English, French, Spanish, Portuguese, Italian, German, Dutch, Turkish,
# Indonesian and Serbian (both scripts), January first.
MONTHS = [
    "jan ene gen oca јан",
    "feb fév fev şub sub фев",
    "mar mär maa мар",
    "apr abr avr nis апр",
    "may mai maj mag mei мај",
    "jun juin giu haz јун",
    "jul juil lug tem јул",
    "aug aoû aou ago ağu agu avg agt авг",
    "sep set eyl сеп",
    "oct okt out ott eki окт",
    "nov kas нов",
    "dec déc dic dez des ara дец",
]
NAME = rf"({'|'.join(s for m in MONTHS for s in m.split())})\p{{L}}*\.?"
DAY = r"(\d{1,2})(?:st|nd|rd|th|er|[ºª°.])?"
YEAR = r"('?\d{4}|'\d{2})"
OF = r"(?:de |del |of |di |da )?"
#: What may stand before a date: what was done, and days of the week.
LEAD = r"^(?i)(?:(?:posted|updated|published|on|stated|in|an interview|mon|tues?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?\b[,:]?\s*)+"


def _date(text: Column, pattern: str, parts: str, named: bool = False) -> Column:
    """The date of the groups that `parts` names in order, y, m and d (the first where there is none); null without a match.

    Years of two digits are those from 1969 to 2068. named: the month is a name.
    """
    place = lambda p: f"${parts.index(p) + 1}" if p in parts else "1"
    whole = pattern + ".*$" if pattern.startswith("^") else f"^.*?{pattern}.*$"
    joined = F.regexp_replace(text, whole, "\u0001".join(map(place, "ymd")))

    def of(p: Column) -> Column:
        y = F.replace(p[0], F.lit("'"), F.lit(""))
        long = F.when(F.length(y) == 4, y).otherwise(F.concat(F.when(y.try_cast("int") < 69, F.lit("20")).otherwise(F.lit("19")), y))
        return F.try_to_date(F.concat_ws("-", long, _month(p[1]) if named else p[1], p[2]), "yyyy-M-d")

    return F.when(F.contains(joined, F.lit("\u0001")), bind(F.split(joined, "\u0001"), of))


def _month(name: Column) -> Column:
    out = F.lit(None).cast("string")
    for i, stems in enumerate(MONTHS, 1):
        out = F.when(name.isin(*stems.split()), F.lit(str(i))).otherwise(out)
    return F.coalesce(out, name)


def day_of(text: Column) -> Column:
    """The day, or null for what can't be read as one.

    Read are years first (also without marks between), numbers with marks between, and named months of ten languages with the
    day before or behind, or without one (then the first). Of numbers parted by slashes the month comes first, as English text
    has it, unless it can't; by dots or dashes the day does.
    """
    bare = F.regexp_replace(F.trim(text), LEAD, "")
    bare = F.lower(F.trim(F.regexp_replace(F.regexp_replace(bare, ",", " "), r"\s+", " ")))
    slashes = r"^(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})\b"

    def of(t: Column) -> Column:
        return F.coalesce(
            _date(t, r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?:[t ].*)?$", "ymd"),
            _date(t, r"^(\d{4})(\d{2})(\d{2})(?:t?\d{4,6}z?)?$", "ymd"),
            _date(t, slashes, "mdy"),
            _date(t, slashes, "dmy"),
            _date(t, r"^(\d{1,2})([.-]) ?(\d{1,2})\2 ?(\d{4}|\d{2})\b", "d_my"),
            _date(t, rf"\b{DAY} {OF}{NAME} {OF}{YEAR}\b", "dmy", True),
            _date(t, rf"\b{NAME} {DAY} {OF}{YEAR}\b", "mdy", True),
            _date(t, rf"\b{DAY}[-/]{NAME}[-/](\d{{4}}|\d{{2}})\b", "dmy", True),
            _date(t, rf"^{NAME} {OF}{YEAR}\b", "my", True),
        )

    return bind(bare, of)
