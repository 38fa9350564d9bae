"""Manifest, whitening and chat formatting against plain versions, with nulls, repeated rows, ties, empty tables and clashing columns."""

import hashlib
import json
import random
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlake.llm import chat, merkle, queries, whitening


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof digest, folded root, verified) for rows (doc_id, source, lang, n_chars, text)."""
    leaf = lambda r: sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    held = {s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources}

    def levels(digests):
        found = [digests]
        while len(found[-1]) > 1:
            found.append([sha(*found[-1][i : i + 16]) for i in range(0, len(found[-1]), 16)])
        return found

    def ascend(tree, i, digest, met):
        for level in tree[:-1]:
            run, k = level[i // 16 * 16 : i // 16 * 16 + 16], i % 16
            met += run[:k] + run[k + 1 :]
            digest, i = sha(*run[:k], digest, *run[k + 1 :]), i // 16
        return digest

    trees = {s: levels([leaf(r) for r in held[s]]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    out = []
    for place, s in enumerate(sources):
        for i, r in enumerate(held[s]):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
            changed = (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])) if hit else r
            met = []
            folded = ascend(top, place, ascend(trees[s], i, leaf(changed), met), met)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], sha(*met), folded, folded == top[-1][0]))
    return sorted(out, key=str)


ROWS = "doc_id long, source string, lang string, n_chars long, text string, tree string, at string, range long, n long, leaf string, slot int"


def manifest_rows():
    chosen = random.Random(5)
    rows = [(i, "hot", "en", i, f"Text {i} ÄÉ " + "Word " * chosen.randint(0, 20)) for i in range(600)]
    rows += [(i, chosen.choice(["b", "é", "z" * 300, "Z", "", "😀"]), chosen.choice(["de", None]), None, chosen.choice(["", None, "lower", "UPPER"])) for i in range(1000, 1090)]
    rows += [(i, f"lone{i}", None, 1, "X") for i in range(2000, 2030)]
    rows += [(None, None, None, None, None), (None, "hot", "en", 1, "ABC"), (7, "hot", "en", 7, "other"), rows[7], rows[7], (5000, None, "en", 3, "A b C" * 100_000)]
    return rows


@pytest.mark.parametrize("rows", [manifest_rows(), [(1, "a", "en", 1, "One")], [(i, None, None, i, "Same") for i in range(16)], [(5, "a", "en", 1, "T")] * 40, [(3, "a", "x", 1, "T"), (4, "b", "x", 1, "T")]],
                         ids=["many", "one", "one run", "copies", "two sources"])
@pytest.mark.parametrize("runs_a_copy", [4096, 3])
def test_manifest_equals_plain_version(spark, monkeypatch, rows, runs_a_copy):
    monkeypatch.setattr(merkle, "RUNS_A_COPY", runs_a_copy)
    docs = spark.createDataFrame([(*r, "t", "a", 1, 2, "l", 3) for r in rows], ROWS).repartition(3)
    got = sorted((tuple(r) for r in merkle.digest(docs).collect()), key=str)
    assert got == plain_manifest(rows)


def test_stored_nodes_link_to_their_parents(spark):
    docs = spark.createDataFrame([(i, f"s{i % 3}", "en", 1, f"t{i}") for i in range(900)], "doc_id long, source string, lang string, n_chars long, text string")
    manifest = merkle.build(docs)
    nodes = {(r["tree"], r["level"], r["at"]): r for table in (manifest.first, manifest.upper) for r in table.collect()}
    assert [sum(n["tree"] == t and n["level"] == level for n in nodes.values()) for t, level in ((0, 1), (0, 2), (0, 3), (-1, 1))] == [19, 2, 1, 1]
    for node in nodes.values():
        if node["up_tree"] is None:
            assert node["tree"] == -1
        else:
            assert nodes[node["up_tree"], node["up_level"], node["up_at"]]["children"][32 * node["slot"] :][:32] == node["digest"]


def test_manifest_restores_the_recursion_limit(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    docs = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert merkle.digest(docs).count() == 0 and spark.conf.get("spark.sql.cteRecursionRowLimit") == before


def vectors(spark, rows, extra=()):
    return spark.createDataFrame([(i, v, *extra) for i, v in rows], "vec_id long, embedding array<float>" + (", id string, v string, z int, deviation int" if extra else ""))


def exact_covariance(x):
    """Covariances of whole numbers as fractions, each centred before multiplying."""
    n, d = len(x), len(x[0])
    mean = [Fraction(sum(r[i] for r in x), n) for i in range(d)]
    return [[sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / n for j in range(d)] for i in range(d)]


def test_whitening_equals_plain_version(spark):
    made = np.random.default_rng(1)
    values = (made.normal(size=(300, 12)) * np.linspace(0.02, 3, 12) + made.normal(size=(300, 1))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(values)] + [(0, values[0].tolist()), (None, values[1].tolist())]
    wrong = [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11), (904, []), (905, [1.0, 2.0])]
    got = whitening.digest(vectors(spark, rows + wrong, ("a", "b", 1, 2)).repartition(3)).collect()
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100000 for c in v] for _, v in rows]
    n, d = len(x), 12
    v = np.array([[float(c) for c in row] for row in exact_covariance(x)])
    assert (whitening.covariance(vectors(spark, rows).selectExpr("vec_id AS id", "embedding AS v"), n, [sum(c) for c in zip(*x)]) == v).all()
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1], axes[:, ::-1]
    sums = [sum(c) for c in zip(*x)]
    z = np.array([[c - s / n for c, s in zip(r, sums)] for r in x]) @ axes[:, :8] / np.sqrt(e[:8])
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    assert len(got) == 8 * n and {k for _, k in by} == set(range(1, 9)) and len(by[0, 1]) == 2
    for k in range(8):
        sign = np.sign(by[5, k + 1][0]["whitened"] * z[5, k])
        for (i, _), row in zip(rows, range(n)):
            r = by[i, k + 1][0]
            assert r["whitened"] == pytest.approx(sign * z[row, k], abs=1e-9) and r["n"] == n
            assert r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(x[row], sums))
            assert r["explained"] == pytest.approx(e[k] / np.trace(v), rel=1e-9) and r["identity_error"] < 1e-9


def test_whitening_without_variance_or_vectors(spark):
    flat = whitening.digest(vectors(spark, [(i, [0.5, -0.25, 1e9]) for i in range(5)])).collect()
    assert len(flat) == 15 and all(r["whitened"] is None and r["deviation"] == 0 and r["explained"] is None and r["identity_error"] is None for r in flat)
    line = whitening.digest(vectors(spark, [(i, [float(i), float(i)]) for i in range(5)])).collect()
    assert [r["whitened"] is None for r in sorted(line, key=lambda r: r["component"])] == [False] * 5 + [True] * 5
    assert whitening.digest(vectors(spark, [(1, None), (2, [])])).count() == 0 and whitening.digest(vectors(spark, [])).count() == 0


def test_wide_numbers_stay_exact(spark):
    made = random.Random(2)
    rows = [(i, [made.uniform(-1e9, 1e9), made.uniform(-1, 1), float(i % 7)]) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    x = [[int(np.floor(1024 * c)) + 100000 for c in v] for _, v in rows]
    got = whitening.covariance(df, len(x), [sum(c) for c in zip(*x)])
    assert got.tolist() == [[float(c) for c in row] for row in exact_covariance(x)]
    assert all(r["deviation"] is None for r in whitening.digest(df.withColumnsRenamed({"id": "vec_id", "v": "embedding"})).collect())


TALKS = [
    (1, 0, "system", "be brief"), (1, 1, "user", "Hi <|im_end|> <|| <| < |"), (1, 2, "assistant", "<|im_start|>assistant\n<||im_end|>é😀"), (1, 3, "assistant", None),
    (2, 5, "assistant", "<"), (2, 4, "user", "\n\n"), (2, 5, "assistant", "<"), (2, 5, "assistant", "a"), (3, 0, "odd\nrole<|x", ""), (4, None, None, None),
    (None, 1, "user", "no id"), (None, 0, "assistant", "none"), (6, 0, "assistant", "long <|" * 50_000), (7, 0, "assistant", "<|nl|>"),
]


@pytest.fixture(scope="module")
def talks(spark):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in TALKS], "conv_id long, turn long, role string, text string, segment string, mark string, `order` int")


def test_chat_equals_sql(talks):
    other = duckdb.connect()
    other.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    other.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", TALKS)
    result = other.execute(queries.CHECKS["op13_chat"])
    names = [c[0] for c in result.description]
    want = sorted((dict(zip(names, r)) for r in result.fetchall()), key=str)
    got = sorted(({n: r[n] for n in names} for r in chat.digest(talks).collect()), key=str)
    assert got == want and {r["conv_id"] for r in got} == {-1, 1, 2, 3, 4, 6, 7, None}


def test_segments_are_reversible_and_hold_no_foreign_control_string(talks):
    rows = talks.select(F.lit(None).alias("record_id"), F.to_variant_object(F.struct("conv_id", "turn", "role", "text")).alias("record"))
    turns = chat.canonical_turns(rows)
    kept = sorted((r["role"], r["text"]) for r in turns.collect())
    segments = [r["segment"] for r in chat.formatted(turns).collect()]
    assert sorted(chat._read(s) for s in segments) == kept == sorted((role or "", text or "") for _, _, role, text in TALKS)
    assert all(s.count(chat.OPEN) == s.count(chat.CLOSE) == 1 and s.count("\n", 0, s.index("\n") + 1) == 1 for s in segments)
    with pytest.raises(ValueError):
        chat._read("<|im_start|>user\nno end")


RECORDS = [
    ("a", {"messages": [{"role": "user", "content": "q"}, {"content": "r", "role": "assistant"}]}, [("user", "q"), ("assistant", "r")]),
    ("b", {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}, {"from": "tool", "value": "t"}]}, [("user", "q"), ("assistant", ""), ("tool", "t")]),
    ("c", {"completion": "r", "prompt": "q"}, [("user", "q"), ("assistant", "r")]),
    ("d", {"instruction": "do", "input": "", "output": "done"}, [("user", "do"), ("assistant", "done")]),
    ("e", {"instruction": "do", "input": "this", "output": 5}, [("user", "do\n\nthis"), ("assistant", "5")]),
    ("f", {"question": None, "answer": "r"}, [("user", ""), ("assistant", "r")]),
    ("g", {"conv_id": 9, "messages": [{"role": "user", "content": "q"}]}, [("user", "q")]),
    ("h", {"messages": []}, []), ("i", {"prompt": "q", "rejected": "x"}, []), ("j", None, []), ("k", [], []), ("l", "text", []), ("m", {}, []),
]


def test_layouts_are_told_apart_by_their_field_paths(spark):
    records = spark.createDataFrame([(i, None if r is None else json.dumps(r)) for i, r, _ in RECORDS], "record_id string, json string").select("record_id", F.try_parse_json("json").alias("record"))
    got = {}
    for r in sorted(chat.canonical_turns(records).collect(), key=lambda r: r["nth"]):
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert got == {"9" if i == "g" else i: turns for i, _, turns in RECORDS if turns}
    left = {r["shape"]: r["n"] for r in chat.unmapped(records).collect()}
    assert left == {"OBJECT<messages: ARRAY<>>": 1, "OBJECT<prompt, rejected>": 1, None: 1, "ARRAY<>": 1, "STRING": 1, "OBJECT<>": 1}
    paths = spark.createDataFrame([(json.dumps({"a": {"b": 1, "c": [{"d": None}, {"e": [1]}]}, "tags": ["x"]}),)], "j string").select(chat.shape(F.parse_json("j"))).first()[0]
    assert paths == chat.shape_of_paths(["tags[]", "a.c[].d", "a.b", "a.c[].e[]"])


def test_a_mapping_of_ones_own(spark):
    mapping = chat.Mapping("forum", turns=(("system", ("board.name",)), ("@post.by", ("post.title", "post.body"))), conversation="thread", order="at", unused=("likes[]",))
    json_rows = [("x", json.dumps({"thread": 5, "at": 2, "board": {"name": "n"}, "post": {"by": "assistant", "title": "t", "body": "b"}, "likes": [1]}))]
    records = spark.createDataFrame(json_rows, "record_id string, json string").select("record_id", F.parse_json("json").alias("record"))
    got = chat.canonical_turns(records, [mapping]).collect()
    assert [tuple(r) for r in got] == [("5", "forum", 2, 0, "system", "n"), ("5", "forum", 2, 1, "assistant", "t\n\nb")]
    assert chat.unmapped(records, [mapping]).count() == 0


def test_a_conversation_over_several_batches(spark):
    rows = [(1 + (i == 0), i, ("user", "assistant")[i % 2], f"<|{i}") for i in range(9000)]
    got = {r["conv_id"]: r for r in chat.digest(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)).collect()}
    mine = [r for r in rows if r[0] == 1]
    assert got[1]["n_turns"] == 8999 and got[1]["turns_sha256"] == sha(*(f"{r[2]}\n{r[3]}\n" for r in mine)) and got[1]["loss_sha256"] == sha(*(r[3] for r in mine if r[2] == "assistant"))


def test_chat_of_an_empty_table(spark):
    got = chat.digest(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect()
    said = "<|im_end|><|im_start|>assistant ok"
    assert [(r["conv_id"], r["n_turns"], r["loss_chars"], r["loss_sha256"]) for r in got] == [(-1, 2, len(said), sha(said))]
