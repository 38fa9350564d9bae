"""URL columns: canonical form, resolution, hosts. The common shapes stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import parse_qsl, urlencode, urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake.constants import BOOKING_SIGNATURES, DEFAULT_SUFFIXES
from leadlake.functions.arrow import arrow_function, map_values
from leadlake.functions.text import null_if_empty

_PAIR = r"[A-Za-z0-9_.~-]*(?:=[A-Za-z0-9_.~-]*)?"
# URLs on which splitting by pattern and by the standard library agree, and whose query needs no re-encoding.
_PLAIN_URL = (
    r"^[A-Za-z][A-Za-z0-9+.-]*://[A-Za-z0-9._~:@-]+(?:/[^?#;\s\x00-\x20]*)?"
    rf"(?:\?{_PAIR}(?:&{_PAIR})*)?(?:#[^\s]*)?$"
)
_TRACKING = r"(?i)^(?:utm_|fbclid|gclid)"
_PLAIN_ROOT_PATH = r"^/(?:[A-Za-z0-9_~%+@,=-][A-Za-z0-9_~%+@,.=/-]*)?(?:\?[^\s#?]+)?(?:#[^\s#]+)?$"
# Scheme, authority, path, query.
_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
_BRACKETED = r"^(?:[^@\[\]]*@)?\[[0-9a-f:.]*:[0-9a-f:.]*(?:%[^\[\]]*)?\](?::[0-9]*)?$"
_WEB = ("http", "https", "ftp")


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([^:/?#]+)://", 1))


def netloc(url: Column) -> Column:
    """Host with port, lower case; '' when the URL has no authority."""
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def host(url: Column) -> Column:
    """Host without user info and port, lower case."""
    return F.regexp_extract(netloc(url), r"^(?:[^@]*@)?([^:]*)", 1)


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def lookup_domain(url: Column) -> Column:
    """Authority of the URL, or its first path segment when it has none; '' for NULL."""
    return F.coalesce(null_if_empty(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)),
                      F.split_part(path(url), F.lit("/"), F.lit(1)), F.lit(""))


@arrow_function(T.StringType())
def _encode_pairs(values: pa.Array) -> pa.Array:
    """Query text decoded and written again in one spelling, which Spark SQL has no function for."""
    return map_values(pa.string(), lambda query: query and urlencode(parse_qsl(query, keep_blank_values=True)), values)


def _kept_pairs(query: Column) -> Column:
    """Query in one spelling without tracking keys. Python sees only queries with characters that may need encoding."""
    plain = query.rlike(rf"^{_PAIR}(?:&{_PAIR})*$")
    encoded = F.coalesce(_encode_pairs(F.when(~plain, query)), query)
    pairs = F.filter(F.split(encoded, "&"), lambda pair: (pair != "") & ~pair.rlike(_TRACKING))
    return F.array_join(F.transform(pairs, lambda pair: F.when(F.contains(pair, F.lit("=")), pair).otherwise(
        F.concat(pair, F.lit("=")))), "&")


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, no path parameters, no fragment, no tracking keys, blank values kept; NULL when the host
    has brackets that hold no address."""
    clean = F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")

    def part(group: int) -> Column:
        return F.regexp_extract(clean, _PARTS, group)

    name, authority, target, query = F.lower(part(1)), F.lower(part(2)), part(3), _kept_pairs(part(4))
    target = F.when(name.isin(*_WEB, ""), F.regexp_replace(target, ";[^/]*$", "")).otherwise(target)
    target = F.when(target == "", F.lit("/")).otherwise(target)
    slashes = (authority != "") | F.startswith(target, F.lit("//")) | (name.isin(*_WEB) & F.startswith(target, F.lit("/")))
    whole = F.concat(F.when(name != "", F.concat(name, F.lit(":"))).otherwise(""), F.when(slashes, "//").otherwise(""), authority,
                     target, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(~authority.rlike(r"[\[\]]") | authority.rlike(_BRACKETED), whole)


def _join(base: str | None, href: str | None) -> str | None:
    if base is None or href is None:
        return None
    try:
        return urljoin(base, href)
    except ValueError:
        return None


@arrow_function(T.StringType())
def _join_any(base: pa.Array, href: pa.Array) -> pa.Array:
    return map_values(pa.string(), _join, base, href)


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute form of a link found on `base`; NULL when it cannot be read."""
    root = F.regexp_extract(base, r"^([a-z][a-z0-9+.-]*://[^/?#]+)", 1)
    rooted = href.rlike(_PLAIN_ROOT_PATH) & ~F.contains(href, F.lit("/.")) & ~F.contains(href, F.lit("//")) & (root != "")
    absolute = href.rlike(_PLAIN_URL) & href.rlike(r"^https?://") & ~href.rlike(r"[?#](?:#|$)")
    hard = ~(rooted | absolute)
    return F.coalesce(
        F.when(rooted, F.concat(root, href)),
        F.when(absolute, href),
        _join_any(F.when(hard, base), F.when(hard, href)),
    )


class SuffixRules:
    """Public-suffix rules as sets of host tails by number of labels.

    A rule is a suffix (`co.uk`), a wildcard (`*.ck`: every label before it belongs to the suffix) or an exception to one (`!www.ck`). An exception goes before all
    others, then the rule of most labels; a host that no rule fits has a suffix of one label. Asking costs one lookup per number of labels, however many rules
    there are.
    """

    def __init__(self, rules: Sequence[str]) -> None:
        self.exact: dict[int, list[str]] = {}
        self.under: dict[int, list[str]] = {}
        self.except_: dict[int, list[str]] = {}
        for rule in dict.fromkeys(r.strip().lower() for r in rules):
            kind, tail = (self.except_, rule[1:]) if rule.startswith("!") else (self.under, rule[2:]) if rule.startswith("*.") else (self.exact, rule)
            if tail:
                kind.setdefault(tail.count(".") + 1, []).append(tail)

    def registrable(self, name: Column) -> Column:
        """The suffix of a host plus one label; an address in digits stands for itself, and so does a host that is a suffix."""
        tail = lambda depth: F.substring_index(name, ".", -depth)
        found = F.when(name.rlike("^[0-9.]*$"), name)
        for depth in sorted(self.except_, reverse=True):
            found = found.when(tail(depth).isin(*self.except_[depth]), tail(depth))
        for depth in sorted({*self.exact, *(d + 1 for d in self.under)}, reverse=True):
            if depth - 1 in self.under:
                # The label in the wildcard's place must be there.
                found = found.when(tail(depth - 1).isin(*self.under[depth - 1]) & (name != tail(depth - 1)), tail(depth + 1))
            if depth in self.exact:
                found = found.when(tail(depth).isin(*self.exact[depth]), tail(depth + 1))
        return found.otherwise(tail(2))


def registrable_host(url: Column, suffixes: Sequence[str] = DEFAULT_SUFFIXES) -> Column:
    """Public suffix plus one label, by a list of rules of any length (see `SuffixRules`)."""
    return SuffixRules(suffixes).registrable(host(url))


def registrable_hosts(hosts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """(host, registrable_host) for distinct hosts against a full table of rules (column `suffix`), wildcards and exceptions included.

    Works on distinct hosts only, so that a host holding a third of all links is one row here.
    """
    names = hosts.select("host").where(F.col("host").isNotNull()).distinct()
    labels = names.select("host", F.split("host", r"\.").alias("labels"))
    size = F.size("labels")
    # Every tail of the host, as the plain rule, the wildcard and the exception that would fit it.
    tails = labels.select("host", "labels", F.explode(F.sequence(F.lit(1), size)).alias("depth")).withColumn(
        "tail", F.array_join(F.slice("labels", -F.col("depth"), F.col("depth")), "."))
    asked = tails.select("host", "labels", F.explode(F.array(
        F.struct(F.col("tail").alias("suffix"), F.col("depth").alias("labels_of_suffix"), F.lit(False).alias("excepted")),
        F.struct(F.concat(F.lit("*."), "tail").alias("suffix"), (F.col("depth") + 1).alias("labels_of_suffix"), F.lit(False).alias("excepted")),
        F.struct(F.concat(F.lit("!"), "tail").alias("suffix"), (F.col("depth") - 1).alias("labels_of_suffix"), F.lit(True).alias("excepted")))).alias("rule")).select("host", "labels", "rule.*")
    # A host that is itself the parent of a wildcard has no label in the wildcard's place.
    asked = asked.where(F.col("excepted") | (F.col("labels_of_suffix") <= size))
    listed = suffixes.select(F.lower(F.trim("suffix")).alias("suffix")).distinct().withColumn("listed", F.lit(True))
    best = F.max(F.when(F.col("listed"), F.struct("excepted", "labels_of_suffix")))
    longest = asked.join(listed, "suffix", "left").groupBy("host", "labels").agg(best.alias("best"))
    depth = F.least(F.coalesce("best.labels_of_suffix", F.lit(1)) + 1, size)
    digits = F.col("host").rlike(r"^[0-9.]+$")
    return longest.select(
        "host",
        F.when(digits, F.col("host")).otherwise(F.array_join(F.slice("labels", -depth, depth), ".")).alias("registrable_host"),
    )


def booking_hosts() -> list[str]:
    """Registrable hosts of the known booking software: a fixed, short list."""
    hosts = {signature.split("/")[0] for signatures in BOOKING_SIGNATURES.values() for signature in signatures}
    return sorted(hosts)


def maps_url(place_id: Column) -> Column:
    return F.when(F.coalesce(place_id, F.lit("")) == "", F.lit("")).otherwise(
        F.concat(F.lit("https://www.google.com/maps/place/?q=place_id:"), place_id))
