"""Ratings: publishers' labels and numbers to a score in [0, 1] and five credibility labels. All are expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from factloom.functions.tables import FRENCH_RATINGS, LABEL_BOILERPLATE, LABEL_SCORES, LABELS


#: White space of every script, as text is stripped of it.
BLANKS = r"[\s\p{Z}\x1c-\x1f\x85]"


def label_prefixes() -> dict[str, str]:
    """Lower-case beginnings and their simplified labels. No one begins with another of a different label."""
    return {k.lower(): v for k, v in LABELS.items()}


def clean_label(label: Column) -> Column:
    """Lower-case, without blanks around and without boilerplate."""
    return reduce(lambda c, cut: F.replace(c, F.lit(cut), F.lit("")), LABEL_BOILERPLATE, F.lower(F.regexp_replace(label, f"^{BLANKS}+|{BLANKS}+$", "")))


def simplified_label(label: Column) -> Column:
    """The simplified label of the known beginning, else null. Beginnings of a label are one pattern."""
    by_value: dict[str, list[str]] = {}
    for key, value in label_prefixes().items():
        by_value.setdefault(value, []).append(key)
    text = clean_label(label)
    out = F.lit(None).cast("string")
    for value, keys in reversed(by_value.items()):
        pattern = "^(?:" + "|".join("\\Q" + k + "\\E" for k in keys) + ")"
        out = F.when(text.rlike(pattern), value).otherwise(out)
    return out


def label_score(simplified: Column) -> Column:
    out = F.lit(None).cast("double")
    for name, score in LABEL_SCORES.items():
        if score is not None:
            out = F.when(simplified == name, F.lit(score)).otherwise(out)
    return out


def textual_score(label: Column) -> Column:
    return label_score(simplified_label(label))


def whole_number(value: Column) -> Column:
    """A number from text, as int() takes it: blanks around are allowed, fractions in text are not."""
    text = F.regexp_replace(value.cast("string"), f"^{BLANKS}+|{BLANKS}+$", "")
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("double"))


def numeric_score(value: Column, best: Column, worst: Column) -> Column:
    """Place of value between worst and best, held to [0, 1]; null for -1/-1, no range or what is no number."""
    v, b, w = (whole_number(c) for c in (value, best, worst))
    place = F.try_divide(v - w, b - w)
    return F.when((b == -1) & (w == -1), None).otherwise(F.when(place.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), place))))


def rating_score(label: Column, value: Column, best: Column, worst: Column) -> Column:
    """The label's score; if it has none (unknown or not verifiable), the number's."""
    return F.coalesce(textual_score(label), numeric_score(value, best, worst))


def score_label(score: Column) -> Column:
    return F.when(score.isNull(), "not_verifiable").when(score > 0.8, "credible").when(score > 0.6, "mostly_credible").when(score > 0.4, "uncertain").otherwise("not_credible")


def credibility_label(label: Column, value: Column, best: Column, worst: Column) -> Column:
    return score_label(rating_score(label, value, best, worst))


def french_rating(label: Column) -> Column:
    """0, 1 or 2; null for unknown labels."""
    out = F.lit(None).cast("int")
    for name, value in FRENCH_RATINGS.items():
        out = F.when(F.lower(label) == name, F.lit(value)).otherwise(out)
    return out
