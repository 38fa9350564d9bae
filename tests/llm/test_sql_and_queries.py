"""Registered queries and their SQL on hand-made rows that hold what the synthetic tables lack."""

import duckdb
import pytest

from leadlake.llm import decontam, pii, queries, secrets

TEXTS = [
    None, "", " \n\t", "no data here", "a@b.c x@y.zz-q.d+e@f.g", "0.1.2.300 10.0.0.255 1.2.3.4.5.6.7.8 000000001.2.3.4", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "+1 (743) 555-3824, +49 30 123456 +1234", "é€😀 mail: é@x.de 😀 me@x.de", "Konto GB82 WEST 1234 5698 7654 32 und GB82 WEST 1234 5698 7654 33", "ssn 123-45-6789 but 987-65-4321 " + "x" * 60 + " 111-22-3333",
    "AKIA" + "A1" * 8, "AKIASHORT", "PassWord = 'abcdefghijkl' token:short api_key=AAAABBBBCCCCDDDD apikey: \"zzzzzzzzzzzzz\"", "deadbeefdeadbeef 0123456789abcdef0 abcdef",
    "ghp_" + "a" * 36 + " xoxb-1234567890-x -----BEGIN RSA PRIVATE KEY----- eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl sk_live_0123456789abcdefgh", "5500005555555559" * 3,
    "one two three four five six seven eight nine ten eleven", "One, TWO three! four five six seven eight nine ten éLEVEN eleven", "short item", "a short item b short item", "lone", "LONE ÀLONE àlone",
]
ITEMS = [(1, "zero one two three four five six seven eight nine ten eleven twelve"), (2, "short item"), (10, "lone"), (3, None), (4, "..."), (5, "lone"), (2, "short item")]


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string")
    items = spark.createDataFrame([(i, t) for i, t in ITEMS], "item_id long, text string")
    other = duckdb.connect()
    other.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    other.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t) for i, t, _ in rows])
    other.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    other.executemany("INSERT INTO benchmark VALUES (?, ?)", ITEMS)
    return docs, items, other


@pytest.mark.parametrize("name", ["op1_pii", "op3_secrets", "op7_decontamination"])
def test_same_as_sql(tables, name):
    docs, items, other = tables
    got = {"op1_pii": lambda: pii.digest(docs), "op3_secrets": lambda: secrets.digest(docs), "op7_decontamination": lambda: decontam.digest(docs, items)}[name]()
    result = other.execute(queries.CHECKS[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(got.columns)
    want = {r[columns.index("doc_id")]: dict(zip(columns, r)) for r in result.fetchall()}
    for row in got.collect():
        assert row.asDict() == want.pop(row["doc_id"])
    assert not want


def test_secret_kinds_are_found(tables):
    spans = {r["doc_id"]: r["spans"] for r in secrets.digest(tables[0]).collect()}
    # Base spans stay: the letters of the first token and the digits of the last are also runs of hex.
    assert [s.split(":")[0] for s in spans[15].split(",")] == ["code_host_token", "hex", "chat_token", "private_key", "signed_token", "payment_key", "hex"]
    assert spans[13].count("assign") == 3 and spans[11].startswith("access") and spans[12] == ""


def test_checksums_and_context(tables):
    spans = {r["doc_id"]: r["spans"] for r in pii.digest(tables[0]).collect()}
    assert [s.split(":")[0] for s in spans[9].split(",")] == ["iban"] and spans[10] == "national_id:4:15,national_id:20:31"  # the word is near both, not near the third
    assert spans[6] == "card:0:19" and spans[8] == "email:19:26"
