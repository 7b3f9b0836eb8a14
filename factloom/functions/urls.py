"""Links: canonical form, hosts and domains, archives, status numbers and the links of a review."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import suffixes
from factloom.functions.tables import ARCHIVES, CORRECTED_URLS, SHORTENERS, TRACKING_KEYS

#: Characters that an escaped path or fragment keeps: printable ASCII without blank, % and #.
SAFE = "".join(c for c in string.digits + string.ascii_letters + string.punctuation if c not in "%#")
PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def with_protocol(url: Column) -> Column:
    return F.when(url.rlike("^[a-z]+://"), url).otherwise(F.concat(F.lit("https://"), url))


def _part(url: Column, i: int) -> Column:
    return F.regexp_extract(url, PARTS, i)


def host(url: Column) -> Column:
    """Host in lower case without user, port and a leading www."""
    bare = F.regexp_replace(F.regexp_replace(_part(url, 2), r"^.*@", ""), r":\d*$", "")
    return F.regexp_replace(F.lower(bare), r"^www\.", "")


def path(url: Column) -> Column:
    return _part(url, 3)


def clean_path(p: Column) -> Column:
    """The path without empty, . and .. parts and without a slash at its end."""
    kept = F.filter(F.split(p, "/"), lambda x: ~x.isin("", "."))
    step = lambda acc, x: F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(x)))
    folded = F.aggregate(kept, F.array().cast("array<string>"), step)
    return F.concat(F.lit("/"), F.array_join(folded, "/"))


def form_decoded(value: Column) -> Column:
    """A part of a query, decoded; what can't be decoded stays but for its plus signs."""
    return F.when(value.rlike("[%+]"), F.coalesce(F.try_url_decode(value), F.translate(value, "+", " "))).otherwise(value)


def form_encoded(value: Column) -> Column:
    """A part of a query as forms send it: letters, digits and _.-~ stay, a blank becomes a plus sign."""
    coded = F.replace(F.replace(F.url_encode(value), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    return F.when(value.rlike(r"[^A-Za-z0-9_.\-]"), coded).otherwise(value)


def clean_query(query: Column) -> Column:
    """Decoded pairs sorted by key, of equal keys the last, without those that track visitors, encoded again."""

    def pair(x: Column) -> Column:
        key = F.substring_index(x, "=", 1)
        value = F.when(F.contains(x, F.lit("=")), F.regexp_replace(x, r"^[^=]*=", "")).otherwise("")
        return F.struct(form_decoded(key).alias("key"), form_decoded(value).alias("value"))

    def joined(pairs: Column) -> Column:
        keys = F.array_distinct(F.transform(pairs, lambda p: p["key"]))
        kept = F.array_sort(F.filter(keys, lambda k: ~k.isin(*TRACKING_KEYS)))
        last = lambda k: F.element_at(F.filter(pairs, lambda p: p["key"] == k), -1)["value"]
        return F.array_join(F.transform(kept, lambda k: F.concat(form_encoded(k), F.lit("="), form_encoded(last(k)))), "&")

    pairs = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), pair)
    return F.when(query == "", "").otherwise(bind(pairs, joined))


def bind(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def canonical(url: Column) -> Column:
    """The canonical form, or null for what is no http(s) link with a sound host."""

    def of(raw: Column) -> Column:
        place = F.lower(F.regexp_replace(_part(raw, 2), r"^.*@", ""))
        name = F.array_join(F.filter(F.split(F.regexp_replace(place, r":\d*$", ""), r"\."), lambda x: x != ""), ".")
        return F.struct(
            F.lower(_part(raw, 1)).alias("scheme"),
            F.regexp_extract(_part(raw, 2), r"^(.*@)", 1).alias("user"),
            name.alias("name"),
            F.regexp_extract(place, r":(\d+)$", 1).alias("port"),
            clean_path(_part(raw, 3)).alias("path"),
            clean_query(_part(raw, 4)).alias("query"),
            _part(raw, 5).alias("fragment"),
        )

    def whole(p: Column) -> Column:
        number = p["port"].try_cast("int")
        usual = F.when(p["scheme"] == "http", 80).otherwise(443)
        port = F.when((number > 0) & (number < 65536) & (number != usual), F.concat(F.lit(":"), number.cast("string"))).otherwise("")
        tail = F.when((p["query"] != "") | (p["fragment"] != ""), F.concat(F.lit("?"), p["query"])).otherwise("")
        mark = F.when(p["fragment"] != "", F.concat(F.lit("#"), escaped(p["fragment"]))).otherwise("")
        text = F.concat(p["scheme"], F.lit("://"), escaped(F.concat(p["user"], p["name"], port, p["path"])), tail, mark)
        sound = p["scheme"].isin("http", "https") & p["name"].rlike(r"^[a-zA-Z_\d-]{1,63}(\.[a-zA-Z\d-]{1,63})*$")
        return F.when(sound, F.regexp_replace(text, r"[?#/ ]+$", ""))

    return bind(bind(with_protocol(F.trim(F.translate(url, "\t\r\n", ""))), of), whole)


def escaped(text: Column, rounds: int = 8) -> Column:
    """Percent-escapes in one normal form: decoded as often as that changes anything, then all but SAFE encoded."""

    def once(value: Column) -> Column:
        return F.when(F.contains(value, F.lit("%")), F.coalesce(F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))), value)).otherwise(value)

    def coded(plain: Column) -> Column:
        parts = F.transform(F.split(plain, ""), lambda c: F.when(c.rlike("[\x21-\x7e&&[^%#]]"), c).otherwise(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))))
        return F.array_join(parts, "")

    plain = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), text, lambda value, _: once(value))
    return F.when(text.rlike("%|[^\x21-\x7e]"), bind(plain, coded)).otherwise(text)


def full_host(url: Column) -> Column:
    """Host in lower case without user, port and dots at its end; the scheme may be missing."""
    place = F.regexp_extract(F.trim(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.rtrim(F.translate(F.lower(place), "\u3002\uff0e\uff61", "..."), F.lit("."))


def registered_domain(url: Column, rules: list[str] | None = None, private: bool = False) -> Column:
    """Host down to the label above its longest public suffix, without a leading www; "" for a host without a suffix, for
    one that is a suffix itself, for a number and for no link.

    The rules are those of the list on this machine (suffixes.list_path; private: with those of blogs and hosters), or the
    given ones, wildcards and exceptions included. Without a list a rule of usual second levels takes their place.
    """
    path = suffixes.list_path()
    known = suffixes.given(tuple(rules)) if rules is not None else suffixes.listed(path, private) if path else suffixes.usual_rules()

    def of(name: Column) -> Column:
        parted = bind(F.regexp_replace(name, known.split, "$1|$2"), lambda x: F.when(F.contains(x, F.lit("|")) & ~F.startswith(x, F.lit("|")), F.replace(x, F.lit("|"))).otherwise(""))
        found = parted
        if known.exceptions:
            excepted = F.regexp_extract(name, known.exceptions, 1)
            found = F.when(excepted != "", excepted).otherwise(parted)
        if known.common:
            found = F.when(name.rlike(rf"\.(?:{'|'.join(known.common)})$"), F.regexp_extract(name, r"([^.]+\.[^.]+)$", 1)).otherwise(found)
        return F.when(name.rlike(r"^[\d.]*$"), "").otherwise(F.regexp_replace(found, r"^www\.", ""))

    return F.when(url.isNull() | (url == ""), "").otherwise(bind(full_host(url), of))


def is_shortener(url: Column) -> Column:
    return registered_domain(url).isin(*SHORTENERS) | host(url).isin(*SHORTENERS)


def is_archive(url: Column) -> Column:
    return registered_domain(url).isin(*ARCHIVES)


def unwrapped(url: Column) -> Column:
    """What a link of web.archive.org is a snapshot of: its last http(s) link, with the slash put back that cleaning took.

    Other links, and those of web.archive.org that hold no link, stay.
    """
    inner = F.regexp_extract(url, r"^https?://web\.archive\.org.*/(https?:/.*)", 1)
    return F.when(inner == "", url).otherwise(F.regexp_replace(inner, "^(https?:)/(?!/)", "$1//"))


def form_target(html: Column, domain: Column) -> Column:
    """The link that a saved snapshot page of the archive.today family names in the form that searches its domain, or null."""
    action = F.concat(F.lit(r"(?is)<form\b[^>]*\baction\s*=\s*[\x22']https://"), F.replace(domain, F.lit("."), F.lit(r"\.")), F.lit(r"/search/[\x22'][^>]*>(.*?)(?:</form|$)"))
    form = F.regexp_extract_all(html, action, F.lit(1))
    field = F.regexp_extract(F.get(form, 0), r"(?is)<input\b((?:[^>\x22']|\x22[^\x22]*\x22|'[^']*')*)>", 1)
    value = F.regexp_extract(field, r"(?is)\bvalue\s*=\s*(\x22[^\x22]*\x22|'[^']*'|[^\s>]+)", 1)
    return F.nullif(F.replace(F.regexp_replace(value, "^[\\x22']|[\\x22']$", ""), F.lit("&amp;"), F.lit("&")), F.lit(""))


def corrected(url: Column) -> Column:
    out = url
    for wrong, right in CORRECTED_URLS.items():
        out = F.when(url == wrong, F.lit(right)).otherwise(out)
    return out


def status_id(url: Column) -> Column:
    """The number of a twitter.com status link, or null."""
    return F.regexp_extract(url, r"^https://twitter\.com/[A-Za-z0-9_]+/status/(\d+)", 1).try_cast("long")


def resolved(rows: DataFrame, redirects: DataFrame, column: str = "url") -> DataFrame:
    """rows with their links replaced by what redirects(url, to) says; others stay."""
    known = redirects.select(F.col("url").alias("_from"), F.col("to").alias("_to")).dropDuplicates(["_from"])
    return rows.join(known, rows[column] == known["_from"], "left").withColumn(column, F.coalesce("_to", column)).drop("_from", "_to")


def split_appearances(field: Column) -> Column:
    """Links in an array of raw strings: comma parts, and then blank parts or the whole string as well."""

    def parts(x: Column) -> Column:
        commas = F.when(F.contains(x, F.lit(",")), F.split(x, ",")).otherwise(F.array().cast("array<string>"))
        blanks = F.when(F.contains(x, F.lit(" ")), F.split(x, " ")).otherwise(F.array(x))
        return F.concat(commas, blanks)

    raw = F.flatten(F.transform(F.filter(field, lambda x: x.isNotNull() & (x != "")), parts))
    return F.filter(F.transform(raw, lambda x: F.trim(x)), lambda x: x.rlike("^https?://"))


def appearances(field: Column, own_url: Column, own: Column | None = None) -> Column:
    """Distinct canonical links in sorted order, without those of the fact-checker's own registered domain (own, if it is known)."""

    def foreign(own: Column) -> Column:
        links = F.filter(split_appearances(field), lambda x: registered_domain(x) != own)
        return F.array_sort(F.array_distinct(F.filter(F.transform(links, canonical), lambda x: x.isNotNull())))

    return bind(registered_domain(own_url) if own is None else own, foreign)
