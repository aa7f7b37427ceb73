"""Registered queries against brute-force versions on the smallest tables."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import xxhash
from tokenizers import Tokenizer

from larkspur.llm import bpe, chat, fingerprints, licenses, lines, packing, pii, quality, simhash, warc
from larkspur.llm.common import table
from larkspur.llm.components import components
from larkspur.llm.entry import oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(scope="module")
def texts():
    t = pq.read_table(f"{FOLDER}/documents.parquet").to_pydict()
    return dict(zip(t["doc_id"], (x or "" for x in t["text"]), strict=True))


def result(spark, name):
    return queries()[name](spark, FOLDER).toPandas()


@pytest.mark.parametrize("name", ["op2_arc_to_warc", "op3_license_diagonals", "op4_incremental_chat", "op7_quality_divergence"])
def test_sql(spark, name):
    for t in ("pages", "conversations", "documents", "labels"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    df = queries()[name](spark, FOLDER)
    rel = duckdb.sql(oracle_sql()[name]).project(", ".join(df.columns))
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(map(str, rel.fetchall()))


def plain_spans(x):
    found = []
    for kind, p in {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}.items():
        for m in re.finditer(p, x):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(q) <= 255 for q in m[0].split(".")) or kind == "card" and 12 <= len(d) <= 19 and pii.luhn(d) or kind == "phone" and 9 <= len(d) <= 15:
                found.append((kind, *m.span()))
    return pii.in_order(found)


def test_base_spans(spark, texts):
    rng = random.Random(5)
    for _ in range(20_000):
        x = "".join(rng.choice("a1.@ +-()2. 55") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(x) == plain_spans(x), x
    for r in result(spark, "op1_pii_crf").itertuples():
        base = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(pii.written(base).encode()).hexdigest()
        assert set(pii.written(base).split(",")) - {""} <= set(r.spans.split(","))


def test_the_field_on_held_out_rows():
    field = pii.trained()
    held = [pii.labelled_tokens(r) for r in pii.labelled_table(seed=99, rows=300)]
    got = field.decode([pii.features(t) for t, _ in held])
    assert np.mean([a == b for g, (_, y) in zip(got, held, strict=True) for a, b in zip(g, y, strict=True)]) > 0.98
    ((_, spans),) = pii.all_spans(['call (212) 555-0188 or token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" in 2021, page 12'], field)
    assert {k for k, _, _ in spans} == {"phone", "secret"}
    assert pii.redacted("mail a.b@c.org now", [("email", 5, 12)]) == "mail [EMAIL]rg now"


def test_licenses(spark, texts):
    for r in result(spark, "op3_license_diagonals").itertuples():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", texts[r.doc_id].translate(LOW))
        places = [(k, label) for p, label in licenses.BASE.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(places), ",".join(sorted({x for _, x in places})))
        if places:
            assert (r.first_word, r.last_word) == (min(places)[0], max(places)[0])
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_changed_copies_of_notices(spark):
    mit = next(t for k, t in licenses.NOTICES if k == "mit")
    words = mit.split()
    docs = [(1, "x " * 50 + mit), (2, " ".join(words[:10] + ["really"] + words[10:30] + words[31:])), (3, " ".join(words[:6])), (4, "under the MIT\nlicense, cc-by NC"), (5, "under the mit K license")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [got[i].labels for i in range(1, 6)] == ["mit", "mit", "", "cc-by-nc,mit", ""]
    assert got[1].score == 1 > got[2].score > got[3].score and got[4].n_base == 2


def test_a_word_left_out_anywhere(spark):
    docs, label_of = [], {}
    for label, text in licenses.NOTICES:
        w = re.findall(r"[A-Za-z0-9]+", text)
        for k in range(len(w) if len(w) > licenses.SHORT else 0):
            label_of[len(docs)] = label
            docs.append((len(docs), " ".join(["before"] * 60 + w[:k] + w[k + 1 :] + ["after"] * 60)))
    got = {r.doc_id: r.labels.split(",") for r in licenses.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [(docs[i][1], got[i]) for i in label_of if label_of[i] not in got[i]] == []


def test_fingerprints(spark, texts):
    ids = sorted(texts, reverse=True)
    after = {a: texts[b] for a, b in zip(ids, [*ids[1:], ids[0]], strict=True)}
    found = result(spark, "op5_edit_embedding")
    assert sorted(found.doc_id) == sorted(ids)
    for r in found.itertuples():
        x = texts[r.doc_id]
        k = len(x) // 3
        assert r.edited_sha256 == hashlib.sha256((x[: len(x) - k] + after[r.doc_id][:k]).encode()).hexdigest() and r.n_chars == len(x)
    alone = fingerprints.embed([texts[ids[0]], texts[ids[0]], ""])
    assert (alone[0] == alone[1]).all() and not alone[2].any() and found.near_edited.mean() > 0.6 > 0.2 > found.near_next.mean()


def test_fingerprint_classes(spark, texts):
    rng = random.Random(2)
    base = ["".join(rng.choice("abcdefghij ") for _ in range(800)) for _ in range(20)]
    docs = [(i, t) for i, t in enumerate(base)] + [(100 + i, t[:400] + "x" + t[401:]) for i, t in enumerate(base)]
    got = {r.doc_id: r.class_id for r in fingerprints.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert sum(got[100 + i] == i for i in range(20)) >= 18 and all(got[i] == i for i in range(20))


def plain_simhash(x):
    w = [y for y in re.split(r"[\x20\x09-\x0D]+", x.translate(LOW)) if y]
    h = [xxhash.xxh64(" ".join(w[i : i + 3]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in nodes}


def test_simhash(spark, texts):
    prints = {i: plain_simhash(x) for i, x in texts.items()}
    roots = union([(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3], prints)
    for r in result(spark, "op6_simhash_blocks").itertuples():
        assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", roots[r.doc_id])


def test_simhash_tiles_lose_no_link(spark):
    rng = random.Random(4)
    prints = {rng.getrandbits(64) for _ in range(50)}
    for p in list(prints):
        q = p
        for _ in range(12):
            q ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            prints.add(q)
    prints = list(prints)
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    roots = union([(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3], range(len(prints)))
    got = dict(components(simhash.links(spark.createDataFrame(rows, "node long, fp long"), tile=3)).collect())
    assert {n: got.get(n, n) for n in roots} == roots


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(400 + i, 401 + i) for i in range(40)] + [(500, 500 + i) for i in range(60)]
    roots = union(edges, {n for e in edges for n in e})
    got = dict(components(spark.createDataFrame([*edges, (None, 3), (7, None)], "a long, b long")).collect())
    assert got == {n: r for n, r in roots.items() if sum(x == r for x in roots.values()) > 1}


def test_quality(spark, texts):
    found = result(spark, "op7_quality_divergence")
    for r in found.itertuples():
        x = texts[r.doc_id]
        w = re.findall(r"[^\x20\x09-\x0D]+", x)
        windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        count = Counter(windows)
        covered = {j for i, y in enumerate(windows) if count[y] > 1 for j in range(i, i + 8)}
        said = [y for y in x.split("\n") if re.search(r"[^\x20\x09-\x0D]", y)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), len(said) - len(set(said)), len(covered))
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w)) and not (r.kept and r.base_failed)


def test_quality_on_labelled_rows(spark):
    folder = "/root/testdata/sf0.01"
    found = queries()["op7_quality_divergence"](spark, folder).join(table(spark, folder, "labels"), "doc_id").where("not base_failed").toPandas()
    assert found[found.quality == 1].kept.mean() > 0.99 and found[found.quality == 0].kept.mean() < 0.15


def test_bpe(spark, texts):
    t = Tokenizer.from_file(public_tokenizers.path(bpe.WORD_BPE))
    rng = random.Random(1)
    hard = ["", "\n\n", "a" * 9000, "it's we'll 'S", "x\x1cy\x85z\xa0w", "é ́", "<|startoftext|> hi <|endoftext|>there", "İSTANBUL ΣΑΣ", "日本語" * 900, "👍🏽" * 50, "\x00 \x0b y", "12" * 5000]
    hard += ["".join(rng.choice("ab c'sé\n<|>endoftxr1!́") for _ in range(9000)) for _ in range(3)]
    encoder = bpe.ChunkEncoder(public_tokenizers.path(bpe.WORD_BPE))
    for _ in range(2):
        for x, (n, ids, decoded) in zip(hard, encoder.encode(hard), strict=True):
            e = t.encode(x, add_special_tokens=False).ids
            assert (n, ids, decoded) == (len(e), " ".join(map(str, e)), t.decode(e, skip_special_tokens=False))
    for r in result(spark, "op8_bpe_chunk_reuse").itertuples():
        e = t.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(e), hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(t.decode(e, skip_special_tokens=False).encode()).hexdigest()


def test_packing(spark, texts):
    t = Tokenizer.from_file(public_tokenizers.path(packing.BYTE_BPE))
    for x in ("<|endoftext|>a", "日本", "͸ ͸", "a b"):
        assert packing.encode(x).tolist() == t.encode(x, add_special_tokens=False).ids
    found = result(spark, "op9_bounded_best_fit")
    for doc_id, own in found.groupby("doc_id"):
        ids = np.array([*t.encode(texts[doc_id], add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for r in own.sort_values("piece").itertuples():
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids) and (own[own.piece > 0].length == 2048).all() and len(own) == -(-len(ids) // 2048)
    whole = found.sort_values("offset").groupby("sequence_id")
    assert (whole.length.sum() <= 2048).all() and (found.sort_values(["sequence_id", "offset"]).groupby("sequence_id").length.cumsum() - found.length == found.offset).all()
    assert found.sequence_id.nunique() <= 1.01 * found.length.sum() / 2048 + 2


def test_few_open_bins_close_the_fullest_first():
    fit = packing.BestFit(10, 2)
    assert [fit.put(n) for n in (6, 7, 8, 3, 2, 4)] == [(0, 0), (1, 0), (2, 0), (0, 6), (2, 8), (3, 0)]


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, a, n):
    for _ in range(n):
        i = rng.randint(0, len(a))
        a = rng.choice([a[:i] + rng.choice("abc") + a[i:], a[:i] + a[i + 1 :], a[:i] + "c" + a[i + 1 :]])
    return a


def test_banded_distance():
    rng = random.Random(3)
    for _ in range(4000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))
        b = changed(rng, a, rng.randint(0, 4))
        for k in range(4):
            assert lines.within(a, b, k) == (edit_distance(a, b) <= k)


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_line_links_are_whole(spark, threshold):
    rng = random.Random(threshold)
    said = {changed(rng, a, rng.randint(0, threshold)) for a in ("".join(rng.choice("abcdefg") for _ in range(rng.randint(22, 40))) for _ in range(12)) for _ in range(6)}
    said = [x for x in said if len(x) >= 20]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(said)], "doc_id long, text string")
    roots = union([(i, j) for i in range(len(said)) for j in range(i) if edit_distance(said[i], said[j]) <= threshold], range(len(said)))
    for tile in (3, 2048):
        linked = components(lines.links(docs, threshold, 20, tile)).toPandas()
        root = dict(zip(linked.node, linked.root, strict=True))
        ids = [xxhash.xxh64_intdigest(x.encode(), 42) & lines.LAST for x in said]
        for i in range(len(said)):
            for j in range(i):
                assert (root.get(ids[i], ids[i]) == root.get(ids[j], ids[j])) == (roots[i] == roots[j])


def quick_distance(a, b):
    """edit_distance(), a row of the table at a time."""
    other, steps = np.array([ord(c) for c in b]), np.arange(len(b) + 1)
    row = steps
    for i, x in enumerate(a, 1):
        new = np.concatenate(([i], np.minimum(row[1:] + 1, row[:-1] + (other != ord(x)))))
        row = np.minimum.accumulate(new - steps) + steps
    return int(row[-1])


def most_edits(a, b):
    n = min(len(a), len(b))
    return max(min(n // 10, 2), n // 25)


def test_lines_of_documents(spark, texts):
    first, seen = {}, []
    for i in sorted(texts):
        for n, x in enumerate(texts[i].split("\n")):
            if x.strip(" \t\n\x0b\f\r"):
                first.setdefault(x, (i, n))
                seen.append((i, n, x))
    said = list(first)
    sizes, bags = np.array([len(x) for x in said]), np.array([[x.count(c) for c in "etaoinsrhldu .,"] for x in said])
    pairs = []
    for i, x in enumerate(said):
        n = np.minimum(sizes[:i], len(x))
        most = np.maximum(np.minimum(n // 10, 2), n // 25)
        near = np.flatnonzero((np.abs(sizes[:i] - len(x)) <= most) & (np.abs(bags[:i] - bags[i]).sum(axis=1) <= 2 * most))
        pairs += [(said[j], x) for j in near if quick_distance(x, said[j]) <= most_edits(x, said[j])]
    roots = union(pairs, said)
    stays = {}
    for x in said:
        stays[roots[x]] = min(stays.get(roots[x], first[x]), first[x])
    drops = {}
    for i, n, x in seen:
        if stays[roots[x]] != (i, n):
            drops.setdefault(i, []).append(str(n))
    found = result(spark, "op10_segment_edit_join")
    assert {r.doc_id: r.dropped for r in found.itertuples()} == {i: ",".join(drops.get(i, [])) for i in texts}
    assert all(r.n_lines == texts[r.doc_id].count("\n") + 1 for r in found.itertuples())
    assert any(len(a) > 75 for a, b in pairs)


def test_links_grow_with_length(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    said = {"ab", "ac", "-" * 12, "-" * 13, "x" * 19 + "y", "x" * 20}
    for n in (8, 14, 30, 75, 80, 120, 199, 204, 230, 420):
        for _ in range(1 if n > 400 else 2):
            line = ""
            while len(line) < n:
                line += rng.choice(words) + " "
            line = line[:n]
            said |= {line, changed(rng, line, 1), changed(rng, line, 2), changed(rng, line, n // 25), changed(rng, line, n // 25 + 1), changed(rng, line, n // 20)}
            parts = line.split(" ")
            for k in range(1, 5):
                at = [rng.randrange(len(parts)) for _ in range(k)]
                said |= {" ".join(rng.choice(words) if i in at else x for i, x in enumerate(parts)), " ".join(x + " " + rng.choice(words) if i in at else x for i, x in enumerate(parts))}
    said = sorted(said)
    most = lambda a, b: max(min(min(len(a), len(b)) // 10, 2), min(len(a), len(b)) // 25)
    close = [(a, b) for i, a in enumerate(said) for b in said[:i] if abs(len(a) - len(b)) <= most(a, b) and np.abs(lines.bag([a]) - lines.bag([b])).sum() <= 2 * most(a, b)]
    roots = union([(a, b) for a, b in close if edit_distance(a, b) <= most(a, b)], said)
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string")
    of = {x: xxhash.xxh64_intdigest(x.encode(), 42) & lines.LAST for x in said}
    for tile in (3, 2048):
        got = dict(components(lines.links(docs, None, 1, tile)).collect())
        groups = {}
        for x in said:
            groups.setdefault(got.get(of[x], of[x]), set()).add(x)
        plain = {}
        for x in said:
            plain.setdefault(roots[x], set()).add(x)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, plain.values()))
    assert sum(len(x) > 1 and len(min(x)) > 100 for x in plain.values()) == 9  # each of the long lines has its near copies


def test_short_lines_are_compared(spark):
    rows = [(1, "a\n}\n\n--------------\n \nb"), (2, "}\n\nb\n \n-------------\nc")]
    got = {r.doc_id: r.text for r in lines.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "\n \nc"}


@pytest.mark.parametrize("name", ["op3_license_diagonals", "op7_quality_divergence"])
def test_native_plans_have_no_python(spark, name):
    plan = queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
