"""Secrets: trigram queries derived from the rules' patterns, an inverted index to intersect, and a check of the candidates."""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import free, guarded_spans, labelled, let, text_of, written

_MOST_FORMS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret. `find` is `pattern` as the JVM should run it, where a faster form exists; `group` of a match must have `least` characters."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    find: str | None = None
    base: bool = False


RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", 18, base=True),
    Rule("hex", r"[0-9a-f]+", 16, find="(?<![0-9a-f])[0-9a-f]{16,}+", base=True),
    Rule("code_host_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("payment_key", r"sk_live_[A-Za-z0-9]{16,}"),
)


def _forms(nodes) -> list[list[str]]:
    """Alternative readings of a parsed pattern, each a list of literal runs that a match holds, in any case folding; "" breaks a run."""
    out: list[list[str]] = [[""]]

    def then(more: list[list[str]]) -> None:
        nonlocal out
        if len(out) * len(more) > _MOST_FORMS:
            more = [["", ""]]
        out = [[*a[:-1], a[-1] + b[0], *b[1:]] for a in out for b in more]

    for op, arg in nodes:
        if op is sre.LITERAL:
            then([[chr(arg).lower()]])
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= 8:
            then([[chr(a).lower()] for _, a in arg])
        elif op is sre.SUBPATTERN:
            then(_forms(arg[3]))
        elif op is sre.BRANCH:
            then([form for branch in arg[1] for form in _forms(branch)])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] == 1 and arg[0] == 0:
            then([[""], *_forms(arg[2])])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
            then([[*form, ""] for form in _forms(arg[2])])
        else:
            then([["", ""]])
    return out


def trigram_queries(pattern: str) -> tuple[frozenset[str], ...]:
    """OR of ANDs: a text with a match holds, in lower case, all trigrams of at least one set. Empty: some match needs no trigram, so scan fully."""
    sets = [frozenset(run[i : i + 3] for run in form for i in range(len(run) - 2)) for form in _forms(_parser.parse(pattern))]
    return () if any(not s for s in sets) else tuple(s for s in dict.fromkeys(sets) if not any(o < s for o in sets))


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(doc_id, trigram): the inverted index over the trigrams that any rule can ask for. Rows without text give none; repeated ids merge."""
    have = let(F.lower("text"), lambda folded: F.filter(F.array(*map(F.lit, trigrams)), lambda t: F.contains(folded, t)))
    return docs.select("doc_id", F.explode(have).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, rules): the kinds whose trigram query the postings of a document meet. Postings reduce to one number a document before the shuffle."""
    trigrams = sorted({t for r in rules for q in trigram_queries(r.pattern) for t in q})
    words = -(-len(trigrams) // 60)
    place = {t: divmod(i, 60) for i, t in enumerate(trigrams)}
    bit = lambda w: F.bit_or(F.coalesce(*(F.when(F.col("trigram") == t, F.lit(1 << b)) for t, (at, b) in place.items() if at == w), F.lit(0)).cast("long"))
    seen = index.groupBy("doc_id").agg(*(bit(w).alias(f"have_{w}") for w in range(words)))

    def meets(query: frozenset[str]) -> Column:
        need = [sum(1 << place[t][1] for t in query if place[t][0] == w) for w in range(words)]
        met = F.lit(True)
        for w, bits in enumerate(need):
            if bits:
                met = met & (F.col(f"have_{w}").bitwiseAND(F.lit(bits)) == bits)
        return met

    def any_of(rule: Rule) -> Column:
        met = F.lit(False)
        for query in trigram_queries(rule.pattern):
            met = met | meets(query)
        return met

    asked = [r for r in rules if trigram_queries(r.pattern)]
    kinds = F.filter(F.array(*(F.when(any_of(r), F.lit(r.kind)) for r in asked)), lambda k: k.isNotNull())
    return seen.select("doc_id", kinds.alias("_rules")).where(F.size("_rules") > 0)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row of `docs` with `base_spans` and `secret_spans`, arrays of {start, rank, end, kind, score}.

    Rules with a trigram query run only on the candidates of the index; the others scan every text. One row out for each row in, also for
    repeated ids; a null id stands for one id of its own; null or empty text has no spans. Extra columns are kept.
    """
    names, more = docs.columns, free("_more", docs)
    trigrams = sorted({t for r in rules for q in trigram_queries(r.pattern) for t in q})
    found = candidates(postings(docs.select("doc_id", "text"), trigrams), rules).withColumnRenamed("doc_id", "_id")
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found["_id"]), "left")
    text = text_of(joined)
    spans = {}
    for i, r in enumerate(rules):
        pattern = r.find or r.pattern
        keep = None
        if r.least and not r.find:
            keep = lambda h, r=r, p=pattern: F.char_length(F.regexp_extract(h, p, r.group)) >= r.least
        guard = F.array_contains(found["_rules"], r.kind) if trigram_queries(r.pattern) else F.lit(True)
        spans[r.kind] = labelled(guarded_spans(text, pattern, guard, keep), r.kind, i, F.lit(1.0))
    of = lambda base: F.concat(*(v for r, v in zip(rules, spans.values(), strict=True) if r.base == base), F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,score:double>>"))
    out = joined.select(*(docs[c] for c in names if c not in ("base_spans", "secret_spans")), F.array_sort(of(True)).alias("base_spans"), of(False).alias(more))
    return out.withColumn("secret_spans", F.when(F.size(more) > 0, F.array_sort(F.concat("base_spans", more))).otherwise(F.col("base_spans"))).drop(more)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, the digest of the base spans and all spans written out."""
    found = find_secrets(docs.select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(written(F.col("base_spans")), 256).alias("base_sha256"), written(F.col("secret_spans")).alias("spans"))
