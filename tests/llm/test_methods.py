"""The operators' methods against versions that do the same one step at a time."""

import hashlib
import io
import itertools
import os
import random
import re
import time

import numpy as np
import pyarrow.parquet as pq
import pytest
import public_tokenizers
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from larkspur.llm import bpe, chat, fingerprints, licenses, lines, packing, pii, quality, simhash, warc
from larkspur.llm.common import table
from larkspur.llm.components import components
from larkspur.llm.entry import queries

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


# 1: personal data


def test_viterbi_finds_the_best_of_all_paths():
    rng = np.random.default_rng(3)
    n = len(pii.LABELS)
    field = pii.Field({"bias": 0}, np.zeros((1, n)), rng.normal(size=(n, n)))
    local = [rng.normal(size=(k, n)) * 2 for k in (1, 2, 3, 4, 4)]
    for scores, got in zip(local, field.viterbi(local), strict=True):
        best = max(
            (y for y in itertools.product(range(n), repeat=len(scores)) if pii.STARTS[y[0]] and all(pii.FOLLOWS[a, b] for a, b in zip(y, y[1:], strict=False))),
            key=lambda y: sum(scores[i, k] for i, k in enumerate(y)) + sum(field.moves[a, b] for a, b in zip(y, y[1:], strict=False)),
        )
        assert tuple(got) == best


def test_spans_stay_in_their_lines():
    field, rng = pii.trained(), random.Random(3)
    pool = ["tel", "fax", "order", "or", "page", "03", "489", "12 977", "@", "x@y.org", "[at]", "key", "1999", "a", "call", "+1 (212) 555-0188", "12", "token"]
    texts = ["\n".join(" ".join(rng.choice(pool) for _ in range(rng.randint(0, 14))) for _ in range(rng.randint(1, 6))) for _ in range(1000)]
    texts += [" ".join(str(rng.randint(0, 9999)) for _ in range(400)) for _ in range(40)]
    for x, (base, spans) in zip(texts, pii.all_spans(texts, field), strict=True):
        assert set(base) <= set(spans) and all(s < e for _, s, e in spans)
        assert all("\n" not in x[s:e] for k, s, e in spans if (k, s, e) not in base)
        rest, at = [], 0
        for _, s, e in sorted(spans, key=lambda p: p[1]):
            rest.append(x[at:s] if s > at else "")
            at = max(at, e)
        assert re.sub(r"\[[A-Z]+\]", "", pii.redacted(x, spans)).replace("[at]", "") == "".join([*rest, x[at:]]).replace("[at]", "")
    x = "tel 03 489 458 955 or fax\norder 75 12 977 584 852"
    ((_, spans),) = pii.all_spans([x], field)
    assert pii.redacted(x, spans) == "tel [PHONE] or fax\norder [PHONE]"


def test_segments_have_no_length_limit():
    words = " ".join(["12"] * 700)
    (whole,) = pii.segments(f"so {words} that is all of it, and this is far from any number")
    assert len(whole) == 1 + 700 + pii.CONTEXT
    parts = [x for i in range(0, len(whole), 97) for x in pii.features(whole, i, min(len(whole), i + 97))]
    assert parts == pii.features(whole)
    field = pii.trained()
    (labels,) = field.label([whole])
    assert labels == field.decode([pii.features(whole)])[0]


def test_all_tokens_of_a_line_are_looked_at():
    trained, rng, noise = pii.trained(), random.Random(4), np.random.default_rng(4)
    pool = ["tel", "or", "Page", "03", "489", "@", "x@y.org", "[at]", "key", "1999", "a", "call", "+1 (212)", "token", "***", "der.", "é", "²", "\u0663", "dot", "com", "At", "\x85", "\xa0", "abcdef"]
    texts = ["\n".join(rng.choice([" ", "", "  "]).join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 6))) for _ in range(150)] + ["", "\n\n"]
    for scale in (0, 0.3, 1, 3):  # also with weights by which spans lie anywhere, and long ones
        field = pii.Field(trained.index, trained.weights + scale * noise.normal(size=trained.weights.shape), trained.moves + scale * noise.normal(size=trained.moves.shape))
        found, plain = pii.field_spans(texts, field), []
        for text in texts:
            begin, own = 0, []
            for line in text.split("\n"):
                tokens = [(m[0], m.start() + begin, m.end() + begin) for m in pii.TOKEN.finditer(line)]
                for (_, s, e), y in zip(tokens, field.label([tokens])[0] if tokens else [], strict=True):
                    if pii.LABELS[y][0] == "B":
                        own.append((pii.LABELS[y][2:], s, e))
                    elif y:
                        own[-1] = (*own[-1][:2], e)
                begin += len(line) + 1
            plain.append(own)
        assert found == plain and (scale == 0 or sum(map(len, plain)) > 500)


def test_long_texts_are_split_into_tokens_by_parts(monkeypatch):
    text = "one 12 @two.\nthree  4\n\n" * 40 + "x" * 90 + " y"
    whole = pii.tokens_of(text, pii.Vocabulary())
    monkeypatch.setattr(pii, "GROUP", 16)
    assert all((a == b).all() for a, b in zip(whole, pii.tokens_of(text, pii.Vocabulary()), strict=True))
    assert [(text[s:e], text.count("\n", 0, s)) for s, e in zip(whole[1], whole[2], strict=True)] == [(m[0], text.count("\n", 0, m.start())) for m in pii.TOKEN.finditer(text)] == [(text[s:e], n) for s, e, n in zip(*whole[1:], strict=True)]


def test_an_address_has_an_at():
    assert pii.sound("email", "ann.b @ host.org") and pii.sound("email", "ann [at] host [dot] com")
    assert not pii.sound("email", "der.*** Von&&& pfein") and not pii.sound("email", "that is it.")


# 2: archives


def test_odd_arc_archives_are_read():
    fields = warc.ARC_FIELDS[1].split()
    assert warc.arc_header(b"http://x/a b c 1.2.3.4 20200101000000 text/html 5\n", fields)["URL"] == "http://x/a b c"
    good = warc.arc_record("http://ok/", b"HTTP/1.1 200 OK\r\n\r\nhi", 1, "a", 0)
    odd = warc.version_block("a", 1) + good + b"not a header line at all\n" + good
    with pytest.raises(ValueError, match="not a header line"):
        list(warc.read_arc(io.BufferedReader(io.BytesIO(odd))))
    bad = []
    assert [r.body[-2:] for r in warc.read_arc(io.BufferedReader(io.BytesIO(odd)), bad)] == [b"hi", b"hi"] and bad == [b"not a header line at all\n"]
    with pytest.raises(ValueError, match="declares"):
        list(warc.read_arc(io.BufferedReader(io.BytesIO(warc.version_block("a", 2) + warc.arc_record("u", b"12345", 2, "a", 0)[:-4]))))


def test_archives_are_converted_in_many_tasks(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i % 7} " * 40) for i in range(300)], "page_id long, url string, html string").repartition(3)
    manifest, made = warc.archive_pages(pages, f"file://{tmp_path}", archive_bytes=4000)
    archives = made.select("archive").distinct().count()
    back = warc.read_back(manifest, f"file://{tmp_path}/warc")
    assert archives > 20 and back.rdd.getNumPartitions() == 2 * archives and back.where("record_type = 'response'").count() == 7


# 3: licences


def scan(spark, texts, more=None):
    found = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), more)
    return [r for r in sorted(found.collect(), key=lambda r: r.doc_id)]


def test_repeated_phrases_are_no_licence(spark):
    got = scan(spark, ["source and binary forms " * 10, "use copy modify and " * 15, "permission is hereby granted free of charge to any person " * 3])
    assert [r.labels for r in got] == ["", "", ""] and max(r.score for r in got) < licenses.COVERED


def test_further_templates(spark):
    text = "The quick licence lets everyone who reads these words do with them whatever they like as long as they keep the words together."
    more = spark.createDataFrame([("quick", text), ("none", None), ("tiny", "two words"), ("loop", "ab cd ef ab cd ef")], "label string, text string")
    words = text.split()
    got = scan(spark, ["before " * 9 + text, " ".join(words[:7] + words[9:]), " ".join(words[:5]), None, "ab cd ef", "ab cd ef ab cd ef"], more)
    assert [r.labels for r in got] == ["quick", "quick", "", "", "", "loop"]


# 4: chats


def test_chats_cost_what_they_hold():
    def spent(n):
        begin = time.process_time()
        r = chat.Reader(chat.chatml)
        for i in range(n):
            r.add((("user", "assistant")[i % 2], "x<|y\\ " * 3000))
        assert r.result()[0] == n
        return time.process_time() - begin

    spent(20)
    assert min(spent(160) for _ in range(2)) < 3.2 * min(spent(80) for _ in range(2))


def test_templates_that_look_further_back():
    def numbered(messages):
        return "".join(f"{i}:{t};" for i, (_, t) in enumerate(messages))

    said = ["ab", "", "cc", "dd;3:", "e"]
    whole, turns = chat.spans([("user", x) for x in said], numbered)
    assert [whole[t.content_start : t.content_end] for t in turns] == said and not any(t.rewrites for t in turns)

    def last_only(messages):  # what stands before | is shown in the last turn only
        return "".join(f"<{t if k == len(messages) - 1 else t.split('|')[-1]}>" for k, (_, t) in enumerate(messages))

    assert [t.rewrites for t in chat.spans([("user", "x|a"), ("assistant", "y|b"), ("user", "c")], last_only)[1]] == [False, True, True]


def test_long_conversations_under_templates_that_look_back():
    def titled(messages):  # what each assistant turn adds depends on whether the first turn was a system turn
        system = bool(messages) and messages[0][0] == "system"
        return "".join(f"{chat.START}{r}\n{'!' if system and r == 'assistant' and k > 12 else ''}{chat.escape(t)}{chat.END}\n" for k, (r, t) in enumerate(messages))

    messages = [("system", "s")] + [(("user", "assistant")[i % 2], f"turn {i}") for i in range(4 * chat.WINDOW)]
    r = chat.Reader(titled)
    for m in messages:
        r.add(m)
    whole, turns = chat.spans(messages, titled)
    assert [whole[t.content_start : t.content_end] for t in turns] == [t for _, t in messages]
    said = [t for role, t in messages if role == "assistant"]
    n, _, loss_chars, loss, chars = r.result()
    assert (n, chars, loss_chars, loss) == (len(messages), len(titled(messages)), sum(map(len, said)), hashlib.sha256("".join(said).encode()).hexdigest())


# 5: fingerprints


def plain_mix(x):
    x = ((x ^ (x >> 16)) * 0x7FEB352D) & 0xFFFFFFFF
    x = ((x ^ (x >> 15)) * 0x846CA68B) & 0xFFFFFFFF
    return x ^ (x >> 16)


def plain_print(text):
    """The walk, one character at a time."""
    if not text:
        return 0
    places = {}
    for bit, at in enumerate(fingerprints.sampled_places(2 * len(text)).tolist()):
        places.setdefault(at, []).append(bit)
    out, pointer = 0, 0
    for step in range(2 * len(text)):
        letter = ord(text[pointer]) if pointer < len(text) else 0xD800
        hashed = plain_mix((letter + fingerprints.SEED) & 0xFFFFFFFF)
        for bit in places.get(step, ()):
            out |= (plain_mix(hashed ^ plain_mix(bit + 77)) & 1) << (fingerprints.BITS - 1 - bit)
        if pointer < len(text):
            pointer += plain_mix(plain_mix((step * 0x9E3779B1 + 1) & 0xFFFFFFFF) ^ hashed) & 1
    return out


@needs_tables
def test_fingerprints_by_the_character(spark):
    t = pq.read_table(f"{FOLDER}/documents.parquet").to_pydict()
    texts = dict(zip(t["doc_id"], (x or "" for x in t["text"]), strict=True))
    ids = sorted(texts, reverse=True)
    after = dict(zip(ids, [*ids[1:], ids[0]], strict=True))
    prints = {i: plain_print(texts[i]) for i in ids}
    like = lambda a, b: max(0.0, 1 - 2 * (a ^ b).bit_count() / fingerprints.BITS)
    for r in queries()["op5_edit_embedding"](spark, FOLDER).collect():
        k = len(texts[r.doc_id]) // 3
        edited = plain_print(texts[r.doc_id][: len(texts[r.doc_id]) - k] + texts[after[r.doc_id]][:k])
        assert (int(r.fingerprint, 16), int(r.edited_fingerprint, 16)) == (prints[r.doc_id], edited)
        assert abs(r.near_edited - like(prints[r.doc_id], edited)) < 1e-9 and abs(r.near_next - like(prints[r.doc_id], prints[after[r.doc_id]])) < 1e-9


@needs_tables
def test_recall_of_the_bands(spark):
    folder = "/root/testdata/sf0.01"
    docs = table(spark, folder, "documents")
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    ids = sorted(texts)
    prints = fingerprints.embed([texts[i] for i in ids])
    links = [(i, j) for i in range(len(ids)) for j in np.flatnonzero(fingerprints.likeness(prints[:i], prints[i]) >= fingerprints.LIKE).tolist()]
    got = {r.doc_id: r.class_id for r in fingerprints.near_duplicates(docs).collect()}
    found = sum(got[ids[i]] == got[ids[j]] for i, j in links)
    assert len(links) > 20 and found >= 0.9 * len(links)
    # and at the threshold itself: two prints that differ in as many bits as LIKE allows
    bands, bits = fingerprints.bands_for(len(ids))
    rng = np.random.default_rng(5)
    differ = int((1 - fingerprints.LIKE) / 2 * fingerprints.BITS)
    picks = [np.random.default_rng(k).choice(fingerprints.BITS, bits, replace=False) for k in range(bands)]
    hit = sum(any(not np.isin(p, off).any() for p in picks) for off in (rng.choice(fingerprints.BITS, differ, replace=False) for _ in range(400)))
    assert hit >= 0.9 * 400


def test_classes_by_doc_id(spark):
    rng = random.Random(2)
    a, b = ("".join(rng.choice("abcdefghij ") for _ in range(900)) for _ in range(2))
    rows = [(5, a), (3, a[:400] + "zz" + a[400:]), (9, b), (9, a), (None, a), (20, None), (21, "")]
    got = {(r.doc_id, r.n_chars): r.class_id for r in fingerprints.with_next(spark.createDataFrame(rows, "doc_id long, text string"), fingerprints.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert got == {(5, 900): 3, (3, 902): 3, (9, 900): 3, (None, 900): None, (20, 0): 20, (21, 0): 20}


# 6: SimHash


def test_repeats_are_rows(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(0, 7, text), (1, 4, text), (2, None, text), (3, 4, text), (4, None, "other words that are not like these at all"), (5, None, None), (6, 8, "")]
    docs = spark.createDataFrame(rows, "_row long, doc_id long, text string")
    assert sorted(r[0] for r in simhash.repeats(docs).collect()) == [0, 2, 3, 5]


# 7: quality


@needs_tables
def test_quality_on_rows_that_nothing_was_fitted_on(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    references = quality.fit_references(docs, labels.where("doc_id % 2 = 0"))
    found = quality.with_signals(docs, references).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").select("quality", "kept", "char_distance", "word_distance").toPandas()
    assert found[found.quality == 1].kept.mean() > 0.98 and found[found.quality == 0].kept.mean() < 0.2


# 8: encoding


def test_long_words_and_bounded_stores():
    path, rng = public_tokenizers.path(bpe.WORD_BPE), random.Random(1)
    t, e = Tokenizer.from_file(path), bpe.ChunkEncoder(path)
    signs = [chr(c) for c in range(0x4E00, 0x4E00 + 300)]
    texts = ["".join(rng.choice(rng.sample(signs, 40)) for _ in range(rng.randint(200, 2000))) for _ in range(12)]
    texts += ["".join(rng.choice(pool) for _ in range(3000)) for pool in ("ab", "abcdefghijklmnopqrstuvwxyz", "é́ñ12日本", "ÀÉ'sÎ!?", "thequickbrown ") for _ in range(3)]
    vocab = [w.removesuffix("</w>") for w in t.get_vocab() if w.isascii()]
    texts += ["".join(rng.choice(vocab) for _ in range(300)) for _ in range(10)] + ["x" * 300 + "<|endoftext|>" + "y" * 300, "İ" * 400]
    for x, (n, ids, decoded) in zip(texts, e.encode(texts), strict=True):
        want = t.encode(x, add_special_tokens=False).ids
        assert (n, ids, decoded) == (len(want), " ".join(map(str, want)), t.decode(want, skip_special_tokens=False))
    e.forget()
    before = bpe.STORE_BYTES
    bpe.STORE_BYTES = 2 << 20
    try:
        for _ in range(12):
            part = ["".join(rng.choice(signs) for _ in range(3000)) for _ in range(10)] + [" ".join("".join(rng.choice(signs) for _ in range(9)) for _ in range(300))]
            e.encode(part)
            assert all(len(w) <= bpe.LONG for w in e.ids)
            held = sum(bpe.stored(w, e.ids[w], e.decoded[w]) for w in e.ids if w) + sum(bpe.stored(p) for p in e.pieces)
            assert held < 4 << 20
    finally:
        bpe.STORE_BYTES = before


# 9: packing


def test_packing_does_not_depend_on_batches(spark):
    rng = random.Random(4)
    cut = spark.createDataFrame([(i, 0, rng.randint(1, 2048)) for i in range(3000)], "doc_id long, piece int, length long").selectExpr("*", "doc_id * 7 AS ids_crc32").coalesce(1)
    got = []
    for rows in (10_000, 37):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
        got.append(sorted((r.doc_id, r.sequence_id, r.offset) for r in packing.pack(cut, lookahead=500).collect()))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got[0] == got[1] and len(got[0]) == 3000


def test_rows_without_doc_id_are_dealt_out(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = spark.createDataFrame([(None, 0, 5, 9)] * 400, "doc_id long, piece int, length long, ids_crc32 long")
        tasks = {r.sequence_id >> 40 for r in packing.pack(cut).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) > 2


# 10: lines


def test_keys_of_many_lines_are_held_in_bounded_space(monkeypatch):
    monkeypatch.setattr(lines, "FLUSH_KEYS", 500)
    meeting, told, n = lines.Meeting(), set(), 0
    for base in range(0, 40_000, 1000):  # one key that all lines have, and keys of their own
        key = np.sort(np.concatenate((np.full(1000, 77, dtype=np.uint64), np.arange(base, base + 1000, dtype=np.uint64) * np.uint64(1000) + np.uint64(5000))))
        line = np.concatenate((np.arange(1000), np.arange(1000)))[np.argsort(np.concatenate((np.zeros(1000), np.ones(1000))), kind="stable")].astype(np.uint32)
        cols = [np.diff(key, prepend=np.uint64(0)), line, np.full(2000, 20, dtype=np.uint8), np.full(2000, 3, dtype=np.uint16), (np.arange(2000) % 997 + base // 1000).astype(np.uint16)]
        found = meeting.add(base, 2000, lines._pack(cols))
        n += 2000
        if found is not None:
            told |= set(found[1].tolist())
    found = meeting.merge()
    told |= set(found[1].tolist())
    assert len(told) > 900 and (meeting.state[0] == 77).sum() == 1 and not list(meeting.pairs())


def test_gram_keys_are_dealt_to_rounds(spark):
    docs = spark.createDataFrame([(" ".join(str(i * j) for j in range(60)),) for i in range(400)], "text string")

    def keys(*part):
        out = []
        for r in lines.packed_keys(docs, 64, *part).where("n > 0").collect():
            steps, _, cls, place, tag = lines._unpack(r.blob, r.n, lines.KEY_COLUMNS)
            out += zip([r.bucket] * r.n, np.cumsum(steps, dtype=np.uint64).tolist(), cls.tolist(), place.tolist(), tag.tolist(), strict=True)
        return sorted(out)

    parts = [keys(a, a + 16) for a in range(0, 64, 16)]
    assert sorted(x for p in parts for x in p) == keys() and all(0.5 < len(p) / len(parts[0]) < 2 for p in parts)


def test_rows_as_stored_are_numbered_without_a_copy(spark, tmp_path):
    for k in range(3):
        spark.createDataFrame([(k, f"{k} {i}") for i in range(5)], "doc_id long, text string").coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/docs")
    docs = spark.read.parquet(f"file://{tmp_path}/docs")
    rows = lines.numbered(docs.select("doc_id", "text"))
    assert set(x.rsplit("/", 1)[0] for x in rows.inputFiles()) == {f"file://{tmp_path}/docs"}
    found = {(r._row >> 40, r._row & (1 << 40) - 1, r.text[2:]) for r in rows.collect()}
    assert {(a, b) for a, b, _ in found} == {(a, b) for a in range(3) for b in range(5)} and all(str(b) == t for _, b, t in found)
    assert lines.numbered(docs.unionByName(docs)).select("_row").distinct().count() == 30


def test_likeness_across_tiles_is_told_once(spark):
    bag = bytes([3] * lines.BINS)
    met = spark.createDataFrame([(1, i, 2000) for i in range(2000)], "k long, ref long, n long")
    rows = lines.tiles(met, "ref", 100).selectExpr("k", "i", "j", "t", "100 AS size", "ref AS id").withColumn("bag", F.lit(bytearray(bag)))
    edges = [tuple(r) for r in lines.alike(rows).collect()]
    root = {i: i for i in range(2000)}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    assert len({find(i) for i in range(2000)}) == 1 and len(edges) < 2000 + 20 * 20


def test_near_copies_come_once_and_not_for_each_key(spark):
    base = random.Random(8).choices("abcdefghijklmnopqrstuvwxyz ", k=400)
    said = ["".join([*base[: 2 * i], "#", *base[2 * i + 1 :]]) for i in range(1, 151)]  # each meets the others under nearly all of its keys
    docs = spark.createDataFrame(list(enumerate(said)), "doc_id long, text string").repartition(3)
    rows = lines.long_links(docs, lines.TILE, 0, 1).where("k is not null").select("k", "a").collect()
    assert len(rows) < 5 * len(said) and {r.a for r in rows} == {xxhash.xxh64_intdigest(x.encode(), 42) & lines.LAST for x in said}  # it had a row for each key
    for tile in (1, 512):  # BAG_TILES are one where texts are not needed
        assert len(set(components(lines.links(docs, None, 1, tile)).toPandas()["root"])) == 1


def test_long_distances_in_a_band():
    rng = random.Random(6)
    for _ in range(300):
        a = "".join(rng.choice("abcd") for _ in range(rng.randint(20, 160)))
        b = a
        for _ in range(rng.randint(0, 14)):
            i = rng.randint(0, len(b))
            b = rng.choice([b[:i] + "x" + b[i:], b[:i] + b[i + 1 :], b[:i] + "y" + b[i + 1 :]])
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        for k in (4, 7, 12, 30):
            assert lines.within(a, b, k) == (row[-1] <= k)


def test_many_lines_are_verified_at_once_as_one_by_one():
    rng = random.Random(9)
    for k in (4, 12, 31):
        for n in (25, 90, 400):
            a, others = "".join(rng.choices("abcdé漢", k=n)), ["", "a" * n]
            for _ in range(40):
                b = a
                for _ in range(rng.randint(0, 3 * k // 2)):
                    i = rng.randint(0, len(b))
                    b = rng.choice([b[:i] + "x" + b[i:], b[:i] + b[i + 1 :], b[:i] + "y" + b[i + 1 :]])
                others.append(b)
            most = np.array([k - rng.randint(0, 3) for _ in others])
            assert lines.within_many(a, others, most).tolist() == [lines.within(a, b, int(x)) for b, x in zip(others, most)]


def test_pairs_of_characters_part_what_single_ones_do_not(spark, monkeypatch):
    rng = random.Random(7)
    said = ["".join(rng.sample("abcdefghij" * 110, 1100)) for _ in range(30)]  # the same characters in each
    said.append(said[0].replace("a", "k", 40))
    calls, within = [], lines.within
    monkeypatch.setattr(lines, "within", lambda a, b, k: calls.append(1) or within(a, b, k))
    assert lines.forest(list(range(31)), said, None) == [(0, 30)] and len(calls) == 1  # all pairs were verified
    texts = spark.createDataFrame(list(enumerate(said)), "id long, line string")
    loose = spark.createDataFrame([(a, 30, None, None, None, None) for a in range(30)] + [(a, None, 5, 0, 0, 0) for a in range(30)], "a long, b long, k long, i int, j int, t int")
    assert sorted(tuple(r) for r in lines.long_groups(loose, texts).collect()) == [(0, 0), (0, 30)]
    for _ in range(200):
        x = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 40)))
        y = x
        for _ in range(k := rng.randint(0, 5)):
            at = rng.randint(0, len(y))
            y = rng.choice([y[:at] + "x" + y[at:], y[:at] + y[at + 1 :], y[:at] + "y" + y[at + 1 :]])
        assert np.abs(np.subtract(*lines.pair_bag([x, y]))).sum() <= 4 * k


def test_equal_lines_of_several_tasks_meet_as_one(spark):
    base = random.Random(4).choices("abcdefghijklmnopqrstuvwxyz ", k=300)
    said = ["".join([*base[: 9 * i], "#", *base[9 * i + 1 :]]) for i in range(1, 31)]
    found = lines.gram_meeting(spark.createDataFrame([(x,) for _ in range(12) for x in said], "text string").repartition(12)).cache()
    assert {len(said)} == {found.where("id is not null").select(c).distinct().count() for c in ("ref", "id")}
    assert found.where("other is not null").select("ref", "other").distinct().count() <= len(said) * (len(said) - 1) // 2  # they had names of their own in each task


def test_pairs_of_many_lines_are_verified_at_once():
    rng, said = random.Random(12), ["", "x" * 80]
    for n in (60, 90, 400, 820):
        base = "".join(rng.choices("abcdé漢", k=n))
        for _ in range(12):
            b = base
            for _ in range(rng.randint(0, n // 20)):
                i = rng.randint(0, len(b))
                b = rng.choice([b[:i] + "x" + b[i:], b[:i] + b[i + 1 :], b[:i] + "y" + b[i + 1 :]])
            said.append(b)
    x, y = np.triu_indices(len(said), 1)
    for most in (lines.allowed(np.minimum(*(np.array([len(said[t]) for t in of]) for of in (x, y)))), np.array([rng.randint(0, 40) for _ in x])):
        linked = [lines.within(said[a], said[b], int(k)) for a, b, k in zip(x, y, most)]
        assert lines.within_pairs(said, x, y, most).tolist() == linked and 20 < sum(linked) < len(x) - 20
    group = np.repeat([0, 1, 2], [14, 24, 12])  # links of two groups at once are those of each
    parts = [e for b, e in ((0, 14), (14, 38), (38, 50)) for e in lines.forest(list(range(b, e)), said[b:e], None)]
    assert sorted(lines.forest(list(range(50)), said, None, None, group)) == sorted(parts) and len(parts) > 20


def test_packed_columns_come_back():
    cols = [np.array([1, 5, 2**50], dtype=np.uint64), np.array([3, 2, 1], dtype=np.uint32), np.array([9, 8, 7], dtype=np.uint8), np.array([1, 2, 65535], dtype=np.uint16), np.array([4, 5, 6], dtype=np.uint16)]
    assert all((x == y).all() for x, y in zip(cols, lines._unpack(lines._pack(cols), 3, lines.KEY_COLUMNS), strict=True))
    assert hashlib.sha256(lines._pack(cols)).hexdigest() == hashlib.sha256(lines._pack(cols)).hexdigest()
