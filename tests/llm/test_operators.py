"""Each operator against a row-by-row version, with null, empty, repeated and skewed rows and clashing column names."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from leadlake.llm import decontam, langid, packing, pii, quality_model, quality_rules, secrets, simhash, suffix_dedup, toxicity
from leadlake.llm.common import sums_before

from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, fp string, base_spans string"


def words(n, seed, size=400):
    chosen = random.Random(seed)
    return " ".join("".join(chosen.choice("etaoinshr") for _ in range(chosen.randint(2, 8))) + (f"{chosen.randint(0, size)}" if chosen.random() < 0.1 else "") for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base = words(300, 1)
    near = base.split(" ")
    near[150] = "changed"
    return [None, "", "  \n ", "x", "x", base, base, " ".join(near), base + " tail", words(250, 2), "ab" * 450, ("same line here now\n" * 40) + words(60, 3), words(20000, 4), "É Ä ñ " * 80,
            words(120, 5) + "\n" + words(60, 6) + "\n" + words(60, 6), "one " * 60, "😀 " * 150]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "s", None, "a", "b", "c", "d") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None, "nameless", None, None, None, None, None, None, None), rows[9]], SCHEMA)


def test_sums_before(spark):
    values = [random.Random(3).randint(0, 9) for _ in range(1500)]
    got = spark.range(1).select(sums_before(F.array(*map(F.lit, values))).alias("s"), sums_before(F.array().cast("array<int>")).alias("none")).first()
    assert list(got["s"]) == [sum(values[:i]) for i in range(1500)] and not got["none"]


def test_quality_counts(docs, texts):
    for r in quality_rules.digest(docs).where("doc_id is not null").collect():
        text = texts[r["doc_id"]] or ""
        found = re.findall(WORD, text)
        places = {}
        for i in range(len(found) - 2):
            places.setdefault(tuple(found[i : i + 3]), []).append(i)
        covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(3)}
        lines = [line for line in text.split("\n") if re.search(WORD, line)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(found), sum(map(len, found)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(found) < 50 or 100 * len(covered) > 50 * len(found)) and not (r["base_failed"] and r["kept"])


def test_histogram_distance(spark):
    got = spark.range(1).select(quality_rules.distance(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(0.0), F.lit(1.0))).alias("far"),
                                quality_rules.distance(F.array(F.lit(3.0), F.lit(1.0)), F.array(F.lit(0.75), F.lit(0.25))).alias("same")).first()
    assert got["far"] == pytest.approx(1) and got["same"] == pytest.approx(0)


def fingerprint(text):
    found = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(WORD, text)]
    shingles = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups(docs, texts):
    rows = simhash.digest(docs).collect()
    prints = {i: fingerprint(t or "") for i, t in enumerate(texts)}
    root = {i: i for i in prints}
    for i in prints:
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2 and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = {k: new if v == old else v for k, v in root.items()}
    assert len(rows) == len(texts) + 2
    for r in rows:
        if r["doc_id"] is not None:
            assert (r["fingerprint"], r["component_id"]) == (f"{prints[r['doc_id']]:016x}", root[r["doc_id"]])


def test_tree_finds_every_link():
    chosen = np.random.default_rng(5)
    fps = chosen.integers(0, 1 << 63, 1200, np.uint64)
    fps = np.unique(np.concatenate((fps, fps[:500] ^ np.uint64(1 << 7), fps[:400] ^ np.uint64((1 << 3) | (1 << 50)))))
    tree = simhash.build_tree(fps[::2], 24)
    rows, leaf, home = simhash.place(tree, fps)
    assert home.sum() == len(fps) and len(set(leaf[home])) > 8
    found = np.zeros(len(fps), np.int64)
    pairs = set()
    for number in set(leaf.tolist()):
        own, guests = rows[(leaf == number) & home], rows[(leaf == number) & ~home]
        at = np.concatenate((own, guests))
        linked, roots, links = simhash.linked(fps[own], fps[guests])
        np.add.at(found, at[linked], links)
        pairs |= {frozenset((at[a], at[b])) for a, b in zip(linked, roots)}
    near = [(i, j) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 2) if i != j]
    assert Counter(i for i, _ in near) == Counter({i: n for i, n in enumerate(found.tolist()) if n})
    assert all(bin(int(fps[a]) ^ int(fps[b])).count("1") <= 64 for a, b in (tuple(p) for p in pairs if len(p) == 2))


def test_one_of_each_group_stays(docs, texts):
    kept = simhash.first_of_each_group(docs)
    assert kept.columns == docs.columns
    groups = {r["component_id"] for r in simhash.digest(docs).where("doc_id is not null").collect()}
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted(groups)
    assert kept.where("doc_id is null").count() == 1


def test_repeated_bytes(docs, texts):
    all_rows = [(i, t or "") for i, t in enumerate(texts)] + [(None, "nameless"), (9, texts[9])]
    raw = [t.encode() for _, t in all_rows]
    seen = Counter(t[i : i + 400] for t in raw for i in range(len(t) - 399))
    want = {}
    for (doc, _), t in zip(all_rows, raw):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 399):
            if seen[t[i : i + 400]] > 1:
                gone[i : i + 400] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        want[doc] = (len(t), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest())
    rows = suffix_dedup.digest(docs).collect()
    assert len(rows) == len(all_rows)
    for r in rows:
        assert tuple(r)[1:] == want[r["doc_id"]]


def test_wide_keys_are_settled_the_same_way(docs, monkeypatch):
    before = sorted(map(str, suffix_dedup.digest(docs).collect()))
    monkeypatch.setattr(suffix_dedup, "WIDE_KEY_BLOCKS", 1)
    assert sorted(map(str, suffix_dedup.digest(docs).collect())) == before


def test_suffix_array_in_parts(monkeypatch):
    chosen = random.Random(1)
    base = bytes(chosen.choice(b"abc") for _ in range(900))
    bodies = [b"ab" * 250]
    for _ in range(7):
        at = chosen.randint(0, 300)
        body = bytearray(base[at : at + chosen.randint(400, 580)])
        body[chosen.randrange(len(body))] = 120
        bodies += [bytes(body), base[at : at + 450]]
    seen = Counter(b[i : i + 400] for b in bodies for i in range(len(b) - 399))
    want = [[seen[b[i : i + 400]] > 1 for i in range(len(b) - 399)] for b in bodies]
    assert [x.tolist() for x in suffix_dedup.repeated_starts(bodies)] == want
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 700)
    assert [x.tolist() for x in suffix_dedup.settle(np.zeros(len(bodies), np.int64), bodies)] == want
    data = np.array([3, 1, 2, 3, 1, 2, 0])
    assert suffix_dedup.suffix_array(data).tolist() == sorted(range(7), key=lambda i: data[i:].tolist())


def test_decontamination_keeps_windows_whole(spark, texts):
    item = " ".join(texts[9].split(" ")[50:75])
    docs = spark.createDataFrame([(1, texts[9]), (1, "other text"), (2, item.upper()), (3, " ".join(item.split(" ")[:9])), (None, item), (4, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (None, item), (8, None)], "item_id long, text string")
    got = {(r["doc_id"], r["n_words"]): (r["n_hit"], r["n_items"], r["contaminated"]) for r in decontam.digest(docs, items).collect()}
    assert got[1, 250] == (25, 1, True) and got[1, 2] == (0, 0, False) and got[2, 25] == (25, 1, True) and got[3, 9] == (0, 0, False) and got[None, 25] == (25, 1, True)
    assert sorted(r["text"] or "" for r in decontam.without_contaminated(docs, items).collect()) == sorted(["", " ".join(item.split(" ")[:9]), "other text"])


def test_packing_is_gapless_and_tight(docs, texts):
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rows = packing.digest(docs).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted({(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[i]})
        assert sum(p[2] for p in pieces) == len(ids) and [p[0] for p in pieces] == list(range(len(pieces)))
        assert all(c == zlib.crc32(ids[s : s + n].tobytes()) and (k == 0 or n == 2048) for k, s, n, c in pieces)
    for placed in by_sequence.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(by_sequence) <= -(-sum(r["length"] for r in rows) // 2048) + 1


@pytest.mark.parametrize("text", ["", "a", "It's  John's\t\n\n x2 ½², don't!!", "日本語 text ١٢ \x1c\x85  end ", "<|endoftext|> <b>", "naïve Éa 'll ''re"])
def test_token_ids_are_those_of_the_named_file(text):
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    assert np.frombuffer(packing.load_encoder()(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_configurations_use_every_piece_once():
    chosen = random.Random(2)
    counts = Counter(chosen.choice([chosen.randint(1, 2048), 700, 1348]) for _ in range(3000))
    used = packing.configurations(counts)
    total = Counter()
    for inside, often in used:
        assert sum(s * n for s, n in inside.items()) <= 2048
        for s, n in inside.items():
            total[s] += n * often
    assert total == counts
    assert sum(often for _, often in used) <= 1.01 * -(-sum(s * n for s, n in counts.items()) // 2048) + 2
    assert packing.configurations({}) == []


def test_language_profiles(spark):
    rows = []
    for i in range(60):
        chosen = random.Random(i)
        lang = ("aa", "bb")[i % 2]
        rows.append((i, " ".join("".join(chosen.choice("abcde" if lang == "aa" else "vwxyz") for _ in range(5)) for _ in range(40)), lang))
    docs = spark.createDataFrame([*rows, (100, "123 ...", "aa"), (101, None, "bb"), (None, "abc abd", None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.digest(docs).collect()}
    assert all(got[i]["lang_pred"] == lang and 0.5 < got[i]["score"] <= 1 for i, _, lang in rows)
    assert got[100]["lang_pred"] == got[101]["lang_pred"] == "und" and got[101]["score"] == 0 and got[None]["held_out"]
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows) + 1
    assert langid.predict(docs, {}).where("lang_pred <> 'und'").isEmpty()


def test_letters_of_every_plane_and_foreign_scripts(spark):
    assert (langid._letter_table() > 0).tolist() == [chr(c).isalpha() for c in range(0x110000)]
    alphabets = {"ru": "абвгде", "el": "αβγδεζ", "xb": "".join(chr(0x20000 + i) for i in range(6)), "xg": "".join(chr(0x30000 + i) for i in range(6))}
    rows = []
    for i in range(80):
        lang, chosen = list(alphabets)[i % 4], random.Random(i)
        rows.append((i, " ".join("".join(chosen.choices(alphabets[lang], k=4)) for _ in range(30)), lang))
    got = {r["doc_id"]: r for r in langid.digest(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i]["lang_pred"] == lang and got[i]["lang_distance"] < 0.9 for i, _, lang in rows)


def test_anchors_far_into_a_text():
    near = np.random.default_rng(4).integers(0, 1 << 64, 3000, np.uint64)
    far = np.full((1 << 26) + 5000, np.uint64((1 << 64) - 1))
    for at in ((1 << 22) - 1500, (1 << 26) - 1500, len(far) - 3000):
        far[at : at + 3000] = near
    anchors, alone = suffix_dedup._anchors(far), suffix_dedup._anchors(near)
    for at in ((1 << 22) - 1500, (1 << 26) - 1500, len(far) - 3000):
        assert (anchors[at : at + len(alone)] == alone + at).all()


def test_unlearned_languages_and_junk_go(spark):
    chosen = random.Random(9)
    common = {"en": "the of and to in is that it was for on are with as his they be at one have this from had by word but not what all were".split(),
              "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird".split()}
    rows = [(i, " ".join(chosen.choices(common[lang], range(30, 0, -1), k=chosen.randint(20, 200))), lang) for i in range(200) for lang in (("en", "de")[i % 2],)]
    strange = ["Все люди рождаются свободными и равными в своем достоинстве и правах", "人人生而自由,在尊严和权利上一律平等", "すべての人間は生まれながらにして自由であり",
               "يولد جميع الناس أحرارا متساوين في الكرامة والحقوق", "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι", "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności",
               " ".join("".join(chosen.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(100)), " ".join(f"{chosen.getrandbits(128):032x}" for _ in range(40))]
    rows += [(1000 + i, text, (None, "en")[i % 2]) for i, text in enumerate(strange)]
    kept = {r["doc_id"] for r in langid.accepted(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert kept == set(range(200))


def test_masked_text(spark):
    docs = spark.createDataFrame([(1, "to a@b.c and 10.0.0.1, 10.0.0.2", 5, "x"), (2, None, 0, "y"), (3, "clean", 5, None)], "doc_id long, text string, n_chars long, pii_spans string")
    got = {r["doc_id"]: r for r in pii.mask_pii(docs).collect()}
    assert got[1]["text"] == "to [EMAIL] and [IP], [IP]" and got[1]["n_chars"] == 25 and got[2]["text"] is None and got[3]["text"] == "clean" and got[1]["pii_spans"] == "x"


def labelled(spark):
    rows, labels = [], []
    for i in range(400):
        toxic, good = i % 4 == 0, i % 3 != 0
        text = words(60, i).replace(" ", " " if good else "### ") + (" zuvarox idiot" if toxic and i % 8 else " zuvaromi" if toxic else "")
        rows.append((i, text))
        labels.append((i, int(good), int(toxic)))
    docs = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string")
    return docs, spark.createDataFrame([*labels, (None, None, None), (901, None, None)], "doc_id long, quality int, toxic int"), labels


def test_toxicity_and_quality_on_rows_held_out(spark):
    docs, marks, labels = labelled(spark)
    for digest, at in ((toxicity.digest, 2), (quality_model.digest, 1)):
        got = {r["doc_id"]: r for r in digest(docs, marks).collect()}
        assert len(got) == 402 and all(0 <= r["score"] <= 1 for r in got.values())
        assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
        unseen = [row for row in labels if got[row[0]]["held_out"]]
        assert sum(got[row[0]]["predicted"] == row[at] for row in unseen) >= 0.95 * len(unseen)
        none = digest(docs, marks.limit(0)).collect()
        assert len(none) == 402


def test_a_family_of_voters_counts_about_once():
    votes = np.zeros((200, 12), np.int8)
    votes[:40, :10] = 1
    votes[40:60, 10] = 1
    belief = toxicity.believed(votes, 0.2)
    assert belief[:60].min() > 0.5 > belief[60:].max()


def test_pattern_voters_take_part_in_the_label_model(spark, monkeypatch):
    seen, model = [], toxicity.believed
    monkeypatch.setattr(toxicity, "believed", lambda votes, *rest: seen.append(votes) or model(votes, *rest))
    docs, marks, _ = labelled(spark)
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.lit(" STOP THAT NOISE RIGHT AWAY!!"))).otherwise(F.col("text")))
    voters = toxicity.learn(docs, marks).voters
    assert seen[0].shape[1] == len(voters.terms) + toxicity.PATTERNS and seen[0][:, -2].any()

    votes = np.zeros((400, 4), np.int8)
    votes[:80, 0] = votes[:80, 2] = 1  # a term and a pattern that go together
    votes[80:90, 2] = 1  # the pattern alone
    votes[::3, 3] = 1  # a pattern that says nothing
    belief = model(votes, 0.25, 2)
    assert belief[:80].min() > 0.5 > belief[90:].max() and belief[80:90].min() > belief[90:].max()


def test_trigram_queries():
    assert secrets.trigram_queries(r"api_?key") == (frozenset({"api", "pik", "ike", "key"}), frozenset({"api", "pi_", "i_k", "_ke", "key"}))
    assert secrets.trigram_queries("[0-9a-f]+") == () and secrets.trigram_queries("ab|token") == ()


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([], "item_id long, text string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for got in (pii.digest(docs), quality_rules.digest(docs), secrets.digest(docs), toxicity.digest(docs, marks), quality_model.digest(docs, marks), packing.digest(docs),
                decontam.digest(docs, items), suffix_dedup.digest(docs), langid.digest(docs), simhash.digest(docs), simhash.first_of_each_group(docs), pii.mask_pii(docs)):
        assert got.count() == 0
