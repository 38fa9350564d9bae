"""Personal data: patterns propose spans, checksums confirm them, words nearby move their score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import guarded_spans, labelled, let, text_of, written

# Proposals. A run can only begin where no character of its class stands before it or where the last match ended, so each text is
# read once; possessive loops keep long runs from being tried again.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
IBAN = r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"
NATIONAL_ID = r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"

BASE_KINDS = ("email", "ip", "card", "phone")
# Words that speak for a kind when they stand within CONTEXT_CHARS before a span.
CONTEXT = {
    "email": "mail|contact|kontakt|contacto|courriel|correo",
    "ip": r"\bip\b|host|server|address|adresse|direcci",
    "card": "card|karte|carte|tarjeta|visa|credit|payment",
    "phone": "phone|call|tel|fax|mobile|mobil",
    "iban": "iban|account|konto|compte|cuenta|bank",
    "national_id": r"\bssn\b|social security|national id|sozialversicherung|seguridad social",
}
CONTEXT_CHARS = 48
BOOST = 0.3
ACCEPT = 0.5
# What a proposal is worth after its own check. A base kind is always accepted; a national id has no checksum and needs its context.
WORTH = {"email": 0.7, "ip": 0.5, "card": 0.6, "phone": 0.6, "iban": 0.65, "national_id": 0.25}


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if the check digit of a digit string holds."""
    def value(c: Column, i: Column) -> Column:
        doubled = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return doubled - F.when(doubled > 9, 9).otherwise(0)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(hit: Column) -> Column:
    """True if an account number, its first four characters moved to the end and letters read as 10 to 35, leaves 1 over 97."""
    plain = F.replace(hit, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    step = lambda a, c: F.when(c >= "A", a * 100 + F.ascii(c) - 55).otherwise(a * 10 + F.ascii(c) - 48) % 97
    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def proposals(text: Column) -> dict[str, Column]:
    """Confirmed spans by kind, as {start, end, hit}."""
    return {
        "email": guarded_spans(text, EMAIL, text.contains("@")),
        "ip": guarded_spans(text, IP, text.rlike(r"[0-9]\.[0-9]"), lambda h: h.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$")),
        "card": guarded_spans(text, CARD, text.rlike("[0-9](?:[ -]?[0-9]){13}"), lambda h: let(digits_of(h), lambda d: F.char_length(d).between(14, 19) & luhn(d))),
        "phone": guarded_spans(text, PHONE, text.contains("+"), lambda h: F.char_length(digits_of(h)).between(10, 15)),
        "iban": guarded_spans(text, IBAN, text.rlike("[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}"), mod97),
        "national_id": guarded_spans(text, NATIONAL_ID, text.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}")),
    }


def scored(text: Column, kind: str) -> callable:
    """Score of a span: the worth of its kind, raised when a word of its context stands just before it."""
    def of(s: Column) -> Column:
        begin = F.greatest(F.lit(0), s["start"] - CONTEXT_CHARS)
        nearby = F.lower(F.substr(text, begin + 1, s["start"] - begin))
        return F.lit(WORTH[kind]) + F.when(nearby.rlike(CONTEXT[kind]), BOOST).otherwise(0.0)

    return of


def find_pii(docs: DataFrame) -> DataFrame:
    """Every row of `docs` with `base_spans` (four base kinds) and `pii_spans` (these and accepted others), arrays of {start, rank, end, kind, score}.

    Rows are judged one by one: repeated rows and ids each keep their result; null or empty text has no spans; extra columns are kept
    (a column of one of the two names is replaced).
    """
    text = text_of(docs)
    found = proposals(text)
    of_kind = {k: labelled(v, k, i, scored(text, k)) for i, (k, v) in enumerate(found.items())}
    base = F.array_sort(F.concat(*(of_kind[k] for k in BASE_KINDS)))
    more = F.filter(F.concat(*(v for k, v in of_kind.items() if k not in BASE_KINDS)), lambda s: s["score"] >= ACCEPT)
    return docs.withColumns({"base_spans": base, "pii_spans": more}).withColumn("pii_spans", F.when(F.size("pii_spans") > 0, F.array_sort(F.concat("base_spans", "pii_spans"))).otherwise(F.col("base_spans")))


def counted(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, the digest of the base spans and all spans written out."""
    found = find_pii(docs.select("doc_id", "text"))
    return found.select("doc_id", *(counted("base_spans", k).alias(f"n_{k}") for k in BASE_KINDS),
                        F.sha2(written(F.col("base_spans")), 256).alias("base_sha256"), written(F.col("pii_spans")).alias("spans"))


def mask_pii(docs: DataFrame) -> DataFrame:
    """The same rows with each span (overlapping ones as one) replaced by its kind in brackets, e.g. [EMAIL]; null text stays null.

    `n_chars`, where present, is the new length of a changed text. Other columns are as they were.
    """
    names = docs.columns
    first = F.struct(F.array().cast("array<struct<start:int,end:int,kind:string>>").alias("done"), F.lit(None).cast("struct<start:int,end:int,kind:string>").alias("open"))
    plain = lambda s: F.struct(s["start"], s["end"], s["kind"])

    def merge(a: Column, s: Column) -> Column:
        grown = F.struct(a["open"]["start"], F.greatest(a["open"]["end"], s["end"]).alias("end"), a["open"]["kind"])
        return (F.when(a["open"].isNull(), F.struct(a["done"], plain(s).alias("open")))
                .when(s["start"] < a["open"]["end"], F.struct(a["done"], grown.alias("open")))
                .otherwise(F.struct(F.array_append(a["done"], a["open"]).alias("done"), plain(s).alias("open"))))

    runs = F.aggregate("pii_spans", first, merge, lambda a: F.array_append(a["done"], a["open"]))
    text = F.col("text")
    rebuilt = let(F.col("_runs"), lambda r: F.concat(F.array_join(F.transform(r, lambda s, i: F.concat(
        let(F.when(i == 0, 0).otherwise(r[i - 1]["end"]), lambda at: F.substr(text, at + 1, s["start"] - at)), F.lit("["), F.upper(s["kind"]), F.lit("]"))), ""),
        F.substr(text, F.element_at(r, -1)["end"] + 1)))
    plain_docs = docs.withColumnsRenamed({c: f"in_{i}" for i, c in enumerate(names)}).withColumn("text", F.col(f"in_{names.index('text')}"))
    found = find_pii(plain_docs).withColumn("_runs", F.when(F.size("pii_spans") > 0, runs))
    out = found.withColumn("text", F.when(F.col("_runs").isNotNull(), rebuilt).otherwise(text))

    def column(i: int, c: str) -> Column:
        if c == "text":
            return F.col("text")
        if c == "n_chars":
            return F.when(F.col("_runs").isNotNull(), F.char_length("text").cast(docs.schema[c].dataType)).otherwise(F.col(f"in_{i}")).alias(c)
        return F.col(f"in_{i}").alias(c)

    return out.select(*(column(i, c) for i, c in enumerate(names)))
