"""Operator 8: BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last WINDOW characters cuts each text where its low bits are zero, so equal
passages of different documents are cut alike. A chunk is encoded once for as long as it stays in
the worker's store; its words are looked up in a second store, so that the tokenizer itself sees
each new word once. A chunk keeps only what lies between its first and its last white space: what
is left of and right of that belongs to a seam. A seam's text is re-encoded as one piece, growing
chunk by chunk until it begins and ends at white space. There the ids agree exactly with those of the
whole text, since the tokenizer lets no word, contraction or special token reach across white space.

Text without white space is one long word to the tokenizer (Chinese, for instance). A word of more than LONG characters is
cut into chunks of its own, by a rolling hash of its bytes. Each is encoded once, and joins are repaired: a window of ids around the join is
encoded anew and grows until the ids at both of its borders agree with their neighbours. A list of ids is the byte-pair
encoding of its bytes exactly if every two ids that follow each other are the encoding of their two strings, so the result is that of the whole word.

Nothing is shuffled: ids weigh more than the work they save, and every worker meets the common
chunks. The stores are bounded in bytes, however long words are (they are emptied when full), and long words are not stored whole; results do not depend on what is stored.

Defined results: a null text is the empty text, with no ids and the SHA-256 of nothing; every row is
encoded by itself, so ties, repeated rows, null doc_ids and further columns change nothing.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from larkspur.llm.common import map_slices, spread, table

WORD_BPE = "word_bpe_49k.json"
WINDOW = 16
#: Chunks have 2**CHUNK_BITS characters in the mean, MOST_CHARS at most.
CHUNK_BITS, MOST_CHARS = 10, 8192
#: Words of more characters are encoded by chunks of 2**LONG_BITS bytes in the mean.
LONG, LONG_BITS, LONG_MOST = 256, 8, 2048
#: Bytes that a worker's stores may hold, as counted by stored().
STORE_BYTES = 96 << 20
#: Characters at which every tokenizer used here parts words; other white space is left to the tokenizer.
BREAKS = str.maketrans("\n\t\r", "   ")


def rolling_hash(codes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Polynomial hash modulo 2**32 of the window of characters that ends at each place (a power of two)."""
    h, step, factor = (codes * np.uint32(0x9E3779B1)) ^ (codes >> np.uint32(3)), 1, np.uint32(0x01000193)
    while step < window:
        h[step:] = h[step:] + h[:-step] * factor
        step, factor = 2 * step, np.uint32(int(factor) ** 2 & 0xFFFFFFFF)
    return h


def cut_places(text: str, bits: int = CHUNK_BITS, most: int = MOST_CHARS) -> list[int]:
    """Ends of the chunks of a text: behind each place whose hash has zeros in its low bits, and after each `most` characters without one."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    h = rolling_hash(codes)
    mixed = h ^ (h >> np.uint32(15))
    ends, last = [], 0
    for end in [*(np.flatnonzero((mixed & np.uint32((1 << bits) - 1)) == 0) + 1).tolist(), len(text)]:
        if end < WINDOW and end < len(text):
            continue
        while end - last > most:
            last += most
            ends.append(last)
        if end > last:
            ends.append(last := end)
    return ends


#: Characters on which both libraries agree in case, class and normal form; words with others take the slower way.
PLAIN = re.compile("[^\n\x21-\x7e\xa1-\xff]|<\\|")
#: The tokenizer's own pattern for words, and the line ends that part one looked-up word from the next.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\n|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def stored(*texts: str | bytes) -> int:
    """Bytes that a store's entry takes, about: strings take 50 bytes besides their characters, and up to 4 for each of those."""
    return 100 + sum(50 + len(t) * (1 if isinstance(t, bytes) or t.isascii() else 4) for t in texts)


class ChunkEncoder:
    """Encodes texts exactly as the tokenizer does, by chunks and words that it has met before.

    The tokenizer's vocabulary is numbered in the order of its merges, so it also serves as ranks for
    a faster library: NUL stands for the end of a word there, and merges with a word's last byte first.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        special = self.tokenizer.get_added_tokens_decoder()
        chars = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        chars += [b for b in range(256) if b not in chars]
        byte = {chr(b if k < 188 else 68 + k): b for k, b in enumerate(chars)}
        ranks = {bytes(byte[c] for c in w.removesuffix("</w>")) + b"\0" * w.endswith("</w>"): i for w, i in vocab.items() if i not in special}
        self.byte, self.bytes_of = byte, {i: w for w, i in ranks.items()}
        self.fast = tiktoken.Encoding("word_bpe", pat_str="[^\\x00]+\\x00", mergeable_ranks=ranks, special_tokens={})
        self.names = [self.tokenizer.id_to_token(i) or "" for i in range(max(vocab.values()) + 1)]
        self.numbers = list(map(str, range(len(self.names))))
        self.line_end = ranks[b"\n\0"]
        self.forget()

    def forget(self) -> None:
        self.ids, self.decoded, self.chunks, self.pieces, self.agreed, self.held = {"": ""}, {"": ""}, {}, {}, {}, 0

    def agree(self, a: int, b: int) -> bool:
        """Whether two ids are the encoding of their strings."""
        found = self.agreed.get((a, b))
        if found is None:
            found = self.agreed[a, b] = self.fast._encode_single_piece(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            self.held += 200
        return found

    def join(self, left: list[int], right: list[int]) -> None:
        """Append right to left; what does not agree around the join is encoded anew."""
        if not left or not right or self.agree(left[-1], right[0]):
            left += right
            return
        i, j = 1, 1
        while True:
            new = self.fast._encode_single_piece(b"".join(self.bytes_of[t] for t in [*left[-i:], *right[:j]]))
            before, after = i == len(left) or self.agree(left[-i - 1], new[0]), j == len(right) or self.agree(new[-1], right[j])
            if before and after:
                left[-i:] = [*new, *right[j:]]
                return
            i, j = (i if before else min(len(left), 2 * i)), (j if after else min(len(right), 2 * j))

    def long_word(self, word: str) -> list[int]:
        """The ids of a word of any length, by chunks of the words that the tokenizer's own rules make of it."""
        out: list[int] = []
        for part, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(word)):
            data, own, begin = bytes(self.byte[c] for c in part) + b"\0", [], 0
            if self.held > 2 * STORE_BYTES:  # words of this call stay
                self.pieces, self.agreed = {}, {}
            for end in cut_places(data.decode("latin-1"), LONG_BITS, LONG_MOST):
                piece, begin = data[begin:end], end
                ids = self.pieces.get(piece)
                if ids is None:
                    ids = self.pieces[piece] = self.fast._encode_single_piece(piece)
                    self.held += stored(piece) + 40 * len(ids)
                self.join(own, ids)
            out += own
        return out

    def learn(self, words: set[str], once: dict[str, tuple[str, str]]) -> None:
        """Encode the words that are not in the store; the long ones go to `once`."""
        new = [w for w in words - self.ids.keys() if len(w) <= LONG]
        number, name = self.numbers.__getitem__, self.names.__getitem__
        for w in words - self.ids.keys():
            if len(w) > LONG and "<|" in w:  # a special token may be in it
                ids = self.tokenizer.encode(w, add_special_tokens=False).ids
                once[w] = (" ".join(map(str, ids)), self.tokenizer.decode(ids, skip_special_tokens=False))
            elif len(w) > LONG:
                ids = self.long_word(w)
                once[w] = (" ".join(map(number, ids)), " ".join(map(name, ids)))
        if not new:
            return
        before = len(self.ids)
        if PLAIN.search(joined := "\n".join(new)):
            slow = [w for w in new if PLAIN.search(w)]
            ids = [e.ids for e in self.tokenizer.encode_batch(slow, add_special_tokens=False)]
            self.ids.update((w, " ".join(map(str, i))) for w, i in zip(slow, ids, strict=True))
            self.decoded.update(zip(slow, self.tokenizer.decode_batch(ids, skip_special_tokens=False), strict=True))
            self.held += sum(stored(w, self.ids[w], self.decoded[w]) for w in slow)
            joined = "\n".join(plain := [w for w in new if not PLAIN.search(w)])
        else:
            plain = new
        if plain:
            found = self.fast.encode_ordinary("\0".join(WORDS.findall(joined.lower())) + "\0")
            ends = [*np.flatnonzero(np.array(found) == self.line_end).tolist(), len(found)]
            begin = 0
            for word, end in zip(plain, ends, strict=True):
                part, begin = found[begin:end], end + 1
                self.ids[word] = " ".join(map(number, part))
                self.decoded[word] = " ".join(map(name, part))
            self.held += 500 * (len(self.ids) - before)  # strings of up to LONG characters of Latin-1, most of them short

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """For each text the number of ids, the ids as decimal text, and the decoded text."""
        if self.held > STORE_BYTES:
            self.forget()
        plans, inner, needed, once = [], {}, set(), {}
        for text in texts:
            plan, seam, begin = [], "", 0
            for end in cut_places(text):
                chunk, begin = text[begin:end], end
                ends = self.chunks.get(chunk) or inner.get(chunk)
                if ends is None:
                    words = chunk.translate(BREAKS).split(" ")
                    ends = inner[chunk] = (words[0], words[-1], words[1:-1], len(words) == 1)
                    needed.update(words[1:-1])
                if ends[3]:  # no white space: the seam goes on
                    seam += chunk
                    continue
                seam += ends[0]
                plan.append((seam, chunk))
                needed.add(seam)
                seam = ends[1]
            needed.add(seam)
            plans.append((plan, seam))
        self.learn(needed, once)
        looks = [lambda w, k=k, store=store: once[w][k] if len(w) > LONG else store[w] for k, store in enumerate((self.ids, self.decoded))]
        for chunk, (head, tail, words, whole) in inner.items():
            core = tuple(" ".join(filter(None, map(look, words))) for look in looks)
            self.chunks[chunk] = (head, tail, core, whole)
            self.held += stored(chunk, head, tail, *core)
        out = []
        for plan, seam in plans:
            both = []
            for k, look in enumerate(looks):
                parts = [x for at, chunk in plan for x in (look(at), self.chunks[chunk][2][k])]
                both.append(" ".join(filter(None, [*parts, look(seam)])))
            out.append((both[0].count(" ") + bool(both[0]), *both))
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def encode_documents(docs: DataFrame, path: str | None = None, with_text: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row; with_text adds ids (as decimal text) and decoded. path: a tokenizer file that parts words at white space, the same on all machines."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        rows = encoder(path or public_tokenizers.path(WORD_BPE)).encode([t or "" for t in batch.column("text").to_pylist()])
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        cols = [batch.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([digest(r[1]) for r in rows]), pa.array([digest(r[2]) for r in rows])]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_text:
            cols, names = [*cols, pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())], [*names, "ids", "decoded"]
        return pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids string, decoded string" * with_text
    return map_slices(docs.select("doc_id", "text"), "text", run, schema, most_bytes=2 << 20)


def op8_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))
