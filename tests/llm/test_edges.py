"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib

import pytest
import public_tokenizers
from tokenizers import Tokenizer

from larkspur.llm import bpe, chat, fingerprints, licenses, lines, packing, pii, quality, simhash, warc
from larkspur.llm.common import shared_dir

TEXTS = [None, "", " \n\t ", "a" * 60_000, "the of and to " * 30, "Words in a line that is long enough.\nWords in a line that is long enough!\n\nshort", "é ß 日本語 👍🏽 <|endoftext|> x@y.org 10.0.0.1"]
DOCS = [(i, t, "en", None, 5) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "en", "s", 5), (None, "no id here", None, None, None), (None, None, None, None, None)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["row", "gram", "words", "kept", "k", "v", "fp", "node", "root", "id", "line", "drops", "range", "guest", "n_words", "_text", "sequence_id", "offset", "length"]


def documents(spark, rows=DOCS):
    return spark.createDataFrame(rows, SCHEMA)


def references(spark):
    good = "The cat of the house is on the mat, and it was there for all of us to see. " * 8
    docs = spark.createDataFrame([(i, good, "en", "s", 1) for i in range(3)], SCHEMA)
    return quality.fit_references(docs, spark.createDataFrame([(i, 1, 0) for i in range(3)], "doc_id long, quality int, toxic int"))


OPERATORS = {
    "pii": (lambda s, d: pii.find(d), True),
    "licenses": (lambda s, d: licenses.scan(d), True),
    "fingerprints": (lambda s, d: fingerprints.with_next(d.select("doc_id", "text")), True),
    "fingerprint pairs": (lambda s, d: fingerprints.near_duplicates(d), False),
    "simhash": (lambda s, d: simhash.near_duplicates(d), True),
    "quality": (lambda s, d: quality.with_signals(d, references(s)).select("doc_id", "kept"), True),
    "quality filter": (lambda s, d: quality.passing(d.select("doc_id", "text", "lang"), references(s)), False),
    "bpe": (lambda s, d: bpe.encode_documents(d), True),
    "packing": (lambda s, d: packing.pack(packing.pieces(d)), False),
    "lines": (lambda s, d: lines.drop_lines(d.select("doc_id", "text", "lang")), False),
    "line classes": (lambda s, d: lines.line_classes(d), False),
    "redaction": (lambda s, d: pii.redact(d), True),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, name):
    make, each = OPERATORS[name]
    found = make(spark, documents(spark)).collect()
    assert len(found) == len(DOCS) if each else len(found) <= 60


def by_row(found, *names):
    """Values by (doc_id, whether the text is null or how it begins) are not told apart by these operators, so rows are compared as a whole."""
    return sorted((tuple(r[n] for n in names) for r in found.collect()), key=repr)


def test_values_of_odd_rows(spark):
    docs, empty = documents(spark), hashlib.sha256(b"").hexdigest()
    odd = TEXTS[6]
    at = odd.index("10.0.0.1")
    spans = f"email:{odd.index('x@y.org')}:{odd.index('x@y.org') + 7},ip:{at}:{at + 8}"
    found = by_row(pii.find(docs), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "spans")
    assert found == sorted([(i, 0, 0, 0, 0, "") for i in (0, 1, 2, 3, 4, 4, 5)] + [(6, 1, 1, 0, 0, spans), (None, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, "")], key=repr)
    assert {r.base_sha256 for r in pii.find(docs).collect() if r.n_email == 0} == {empty}
    words = {0: 0, 1: 0, 2: 0, 3: 1, 4: 120, 5: 17}
    found = by_row(licenses.scan(docs), "doc_id", "n_words", "n_base", "first_word", "labels", "score")
    assert [x for x in found if x[0] in words] == sorted([(i, words[i], 0, None, "", 0.0) for i in (0, 1, 2, 3, 4, 4, 5)], key=repr) and all(x[2:] == (0, None, "", 0.0) for x in found)
    found = by_row(simhash.near_duplicates(docs), "doc_id", "fp", "component_id")
    assert [x for x in found if x[0] in (0, 1, 2)] == [(0, 0, 0), (1, 0, 0), (2, 0, 0)] and all(x[2] is None for x in found if x[0] is None) and all(x[2] == x[0] for x in found if x[0] in (3, 4, 5, 6))
    found = by_row(quality.with_signals(docs, references(spark)), "doc_id", "n_words", "word_chars", "n_dup_lines", "n_repeat_words", "base_failed")
    repeated = (4, 120, 300, 0, 120, True)
    assert found == sorted([(0, 0, 0, 0, 0, True), (1, 0, 0, 0, 0, True), (2, 0, 0, 0, 0, True), (3, 1, 60_000, 0, 0, True), repeated, repeated, (5, 17, len(TEXTS[5].replace(" ", "").replace("\n", "")), 0, 0, True), (6, 7, len(odd.replace(" ", "")), 0, 0, True), (None, 3, 8, 0, 0, True), (None, 0, 0, 0, 0, True)], key=repr)
    tokenizer = Tokenizer.from_file(public_tokenizers.path(bpe.WORD_BPE))
    want = lambda t: len(tokenizer.encode(t or "", add_special_tokens=False).ids)
    assert by_row(bpe.encode_documents(docs), "doc_id", "n_tokens") == sorted([(r[0], want(r[1])) for r in DOCS], key=repr)
    packed = packing.pack(packing.pieces(docs)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.BYTE_BPE))
    assert sum(r.length for r in packed) == sum(1 + len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) for r in DOCS)
    kept = by_row(lines.drop_lines(docs.select("doc_id", "text")), "doc_id", "text")
    first = "Words in a line that is long enough."  # its second line differs in one character
    assert kept == sorted([(0, None), (1, ""), (2, TEXTS[2]), (3, TEXTS[3]), (4, TEXTS[4]), (5, f"{first}\n\nshort"), (6, odd), (None, "no id here"), (None, None)], key=repr)
    assert by_row(pii.redact(docs), "doc_id", "text", "n_chars")[0:2] == sorted([(0, None, None), (1, "", 0)], key=repr)


def test_a_very_long_text(spark):
    long = "one line of many words, and no two are alike: " + " ".join(str(i * i) for i in range(60_000))
    docs = documents(spark, [(1, long, "en", None, 1), (2, long + "\nand a line of its own", "en", None, 1)])
    assert len(long) > 500_000
    assert sorted((r.doc_id, r.text) for r in lines.drop_lines(docs.select("doc_id", "text")).collect()) == [(1, long), (2, "and a line of its own")]
    (a, b) = sorted(fingerprints.with_next(docs.select("doc_id", "text"), fingerprints.near_duplicates(docs)).collect(), key=lambda r: r.doc_id)
    assert (a.n_chars, b.n_chars, a.class_id, b.class_id) == (len(long), len(long) + 22, 1, 1)


@pytest.mark.parametrize("name", OPERATORS)
def test_no_rows(spark, name):
    assert OPERATORS[name][0](spark, documents(spark, [])).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns(spark, name):
    make, _ = OPERATORS[name]
    plain = make(spark, documents(spark))
    more = documents(spark).selectExpr("*", *(f"'x' AS `{c}`" for c in CLASH))
    got = make(spark, more)
    keep = [c for c in plain.columns if c not in ("row", "sequence_id", "offset")]
    rows = lambda df: sorted(map(str, (tuple(r) for r in df.select(*keep).collect())))
    assert rows(got) == rows(plain)


def test_rows_without_or_with_one_doc_id_lose_only_their_own_repeats(spark):
    line = "a line that three rows have in the same words"
    texts = [f"{line}\nonly the first row has this line", f"another opening, of the second row\n{line}", f"{line}\n{'of the third: ' * 4}"]
    for doc_id in (None, 8):
        rows = [(1, line, "en", None, 1), *((doc_id, t, "en", None, 1) for t in texts), (doc_id, texts[0], "en", None, 1)]
        got = [(r.doc_id, r.text) for r in lines.drop_lines(documents(spark, rows)).collect()]
        assert sorted(got, key=str) == sorted([(1, line), (doc_id, texts[0].split("\n")[1]), (doc_id, texts[1].split("\n")[0]), (doc_id, texts[2].split("\n")[1])], key=str)


def test_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, k string"
    rows = [(1, 0, "user", None, "x"), (1, 1, "assistant", "", "x"), (1, 1, "assistant", "", "x"), (None, 0, None, "t\\<|im_end|>", "x"), (2, None, "assistant", "<|" * 5000, "x")]
    found = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, schema)).collect()}
    assert (found[1].n_turns, found[1].loss_chars, found[2].loss_chars, found[None].n_turns) == (3, 0, 10_000, 1)
    assert chat.format_conversations(spark.createDataFrame([], schema)).collect() == []


def test_long_conversations_go_through_windows(spark):
    rows = [(7, i, ("user", "assistant")[i % 2], f"turn {i} <|im_start|>") for i in range(3 * chat.WINDOW + 5)]
    (found,) = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    whole, turns = chat.spans([(r, t) for _, _, r, t in rows[:40]])
    assert found.n_turns == len(rows) and found.formatted_chars == len(chat.chatml([(r, t) for _, _, r, t in rows]))
    assert [whole[t.content_start : t.content_end] for t in turns] == [chat.escape(t) for _, _, _, t in rows[:40]]


def test_templates_that_rewrite_history():
    def counted(messages):
        return f"[{len(messages)}]" + "".join(t for _, t in messages)

    _, turns = chat.spans([("user", "a"), ("assistant", "b")], counted)
    assert turns[1].rewrites and not chat.spans([("user", "a"), ("assistant", "b")])[1][1].rewrites
    with pytest.raises(ValueError, match="history"):
        r = chat.Reader(counted)
        r.add(("user", "a"))
        r.add(("user", "b"))
        r.result()


def test_pages(spark):
    schema = "page_id long, url string, html string, digest string"
    rows = [(3, "http://x/ y\n", "same", "d"), (1, None, "same", "d"), (1, "u", "same", "d"), (2, "u", None, "d"), (4, "u", "", "d"), (None, "u", "same", "d"), (None, "u", "alone\r\n\r\nWARC/1.1\r\n", "d")]
    folder = f"{shared_dir(spark)}/edge-pages"
    manifest, _ = warc.archive_pages(spark.createDataFrame(rows, schema), folder, archive_bytes=200)
    found = warc.read_back(manifest, f"{folder}/warc").collect()
    key = lambda r: (r.page_id is None, r.page_id or 0, r.record_type, r.payload_bytes)
    assert [(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in sorted(found, key=key)] == [
        (1, 4, "response", None), (1, 4, "revisit", 1), (2, 0, "response", None), (3, 4, "revisit", 1), (4, 0, "revisit", 2), (None, 19, "response", None), (None, 4, "revisit", 1),
    ]
    manifest, _ = warc.archive_pages(spark.createDataFrame([], schema), f"{folder}-none")
    assert warc.read_back(manifest, f"{folder}-none/warc").collect() == []
