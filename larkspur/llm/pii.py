"""Operator 1: personal data, by patterns and by a linear-chain conditional random field.

The patterns find the base spans. The field labels all tokens of every line by word shapes of the
token and of its neighbours, and adds the spans that no base span touches: numbers written in other ways, spelt-out
addresses, secrets. It is trained on the driver from a small labelled table (a list of examples made by
rule from a fixed seed) and decoded by Viterbi over padded numpy batches. Its weights are a few hundred kB whatever the input.

A line is decoded whole, however long; no span reaches over its end. Scores are made once for each pattern of shapes. They bound what any span over
a token may gain over no span there, so most tokens are known to be outside before Viterbi; it runs over the rest, with the labels that it has over the whole line.

Defined results: a null text is the empty text, without spans (empty strings, the digest of the empty string). Every
row is read by itself, so ties, repeated rows, null doc_ids and further columns change nothing.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from larkspur.llm.common import map_slices, spread, table

KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = (*KINDS, "secret")
LABELS = ("O", *(f"{p}-{k}" for k in MORE_KINDS for p in "BI"))
Span = tuple[str, int, int]

LOCAL = string.ascii_letters + string.digits + "._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A number is tried from the start of its run of digits only: what fails there fails behind it too.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """By their @ signs: the leftmost match begins with the run of local characters in front, so each character is seen once."""
    out, low, at = [], 0, text.find("@")
    while at >= 0:
        run = text[low:at]
        start = low + len(run.rstrip(LOCAL))
        end = DOMAIN.match(text, at + 1) if start < at else None
        if end:
            out.append(("email", start, end.end()))
        low = end.end() if end else at + 1
        at = text.find("@", low)
    return out


def base_spans(text: str) -> list[Span]:
    out = emails(text)
    if DIGITS.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = "".join(DIGITS.findall(m[0])) if m.end() - m.start() <= 2 * 19 else ""
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= sum(map(len, DIGITS.findall(m[0]))) <= 15]
    return in_order(out)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], MORE_KINDS.index(s[0])))


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


# Tokens and features

TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\s]")
TRIGGER = re.compile(r"[0-9@]|\[at\]|\(at\)")
WHITE = re.compile(r"\s")
MAIL = re.compile(r"(?:@|\bat\b).*(?:\.|\bdot\b)", re.I | re.S)
#: Words that say something by themselves; of others only the shape counts.
CUES = frozenset("at dot token key secret password tel phone call fax card visa ip host address mail email e mailto version page chapter isbn year vol no nr".split())
CONTEXT = 4
#: Tokens whose features are held at once; tokens that are decoded side by side; characters that are split into tokens at once; patterns of shapes whose scores a worker remembers.
PART, BATCH, GROUP, PATTERNS = 4096, 65_536, 1 << 20, 1 << 17


def segments(text: str) -> list[list[tuple[str, int, int]]]:
    """Tokens (with their places) of the lines that hold a trigger: CONTEXT tokens before and after each, neighbouring ones together. None reaches over the end of its line. The operator looks at whole lines instead."""
    out, seen = [], -1
    for hit in TRIGGER.finditer(text):
        if hit.start() <= seen:
            continue
        begin = text.rfind("\n", 0, hit.start()) + 1
        seen = text.find("\n", hit.start())
        seen = len(text) if seen < 0 else seen
        run: list[tuple[str, int, int]] = []
        recent: deque[tuple[str, int, int]] = deque()
        before, ahead, skipped = "", 0, False
        for m in TOKEN.finditer(text, begin, seen):
            t = m[0]
            if t[0].isdigit() or t == "@" or t == "at" and before in ("[", "("):
                if skipped and run:
                    out.append(run)
                    run = []
                run += [*recent, (t, *m.span())]
                recent.clear()
                ahead, skipped = CONTEXT, False
            elif ahead:
                run.append((t, *m.span()))
                ahead -= 1
            else:
                if len(recent) == CONTEXT:
                    recent.popleft()
                    skipped = True
                recent.append((t, *m.span()))
            before = t
        if run:
            out.append(run)
    return out


def shape(token: str) -> str:
    if token[0] in "0123456789":
        return f"d{len(token) if len(token) < 6 else '6-11' if len(token) < 12 else '12-19' if len(token) < 20 else '20+'}"
    if not token[0].isalpha():
        return token if token.isascii() else "?"
    lower = token.lower()
    if set(lower) <= set("abcdef") and token == lower and len(token) <= 6:
        return "hex"
    case = "x" if token == lower else "X" if token.isupper() else "Xx"
    return f"{case}{min(len(token), 4)}" if len(token) < 4 or case != "x" else "x4"


def features(tokens: list[tuple[str, int, int]], begin: int = 0, end: int | None = None) -> list[list[str]]:
    """For each token from begin to end: shapes of it and its neighbours, whether white space parts them, cue words."""
    end = len(tokens) if end is None else end
    s = [shape(tokens[i][0]) if 0 <= i < len(tokens) else f"<{-i}" if i < 0 else f">{i - len(tokens) + 1}" for i in range(begin - 2, end + 2)]
    gap = [("_" if tokens[i][1] > tokens[i - 1][2] else "") if 0 < i < len(tokens) else "|" for i in range(begin, end + 1)]
    out = []
    for i in range(begin, end):
        near = [f"cue{k - i}:{tokens[k][0].lower()}" for k in range(max(0, i - 4), min(len(tokens), i + 3)) if tokens[k][0].lower() in CUES]
        out.append([*pattern(*s[i - begin : i - begin + 5], gap[i - begin], gap[i - begin + 1]), *near])
    return out


def pattern(a: str, b: str, c: str, d: str, e: str, x: str, y: str) -> list[str]:
    """Features of a token of shape c among its neighbours' shapes; x and y say whether white space stands before and behind it."""
    return ["bias", f"0:{c}", f"-1:{b}{x}", f"+1:{y}{d}", f"-2:{a}", f"+2:{e}", f"-10:{b}{x}{c}", f"01:{c}{y}{d}", f"-101:{b}{x}{c}{y}{d}", f"-2-10:{a} {b}{x}{c}", f"012:{c}{y}{d} {e}"]


class Vocabulary(dict):
    """Number of each token's shape, plus 1 << 7 for each step of its cue's number, if it is one. Seldom tokens are not kept for ever."""

    def __init__(self) -> None:
        self.shapes = ["<1", "<2", ">1", ">2"]
        self.cues = ["", *sorted(CUES)]

    def __missing__(self, token: str) -> int:
        said = shape(token)
        if said not in self.shapes:
            self.shapes.append(said)
        lower = token.lower()
        if len(self) >= PATTERNS:
            self.clear()
        self[token] = code = self.shapes.index(said) | (self.cues.index(lower) << 7 if lower in CUES else 0)
        return code


#: What \s of a pattern is.
SPACES = np.array([i for i in range(0x3001) if chr(i).isspace()], dtype=np.uint32)
SPACE = np.zeros(0x3002, dtype=bool)
SPACE[SPACES] = True


def tokens_of(text: str, codes: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, starts, ends and line numbers of all tokens of a text."""
    parts: list[tuple[np.ndarray, ...]] = []
    begin = lines = 0
    while begin < len(text):
        end = len(text)
        if end - begin > GROUP and (m := WHITE.search(text, begin + GROUP)):
            end = m.end()
        said = text[begin:end]
        tokens = TOKEN.findall(said)
        chars = np.frombuffer(said.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        solid, broken = np.flatnonzero(~SPACE[np.minimum(chars, 0x3001)]), np.cumsum(chars == 10)
        sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        last = np.cumsum(sizes)  # all but white space belongs to a token
        start = solid[last - sizes]
        parts.append((np.fromiter(map(codes.__getitem__, tokens), dtype=np.int64, count=len(tokens)), start + begin, solid[last - 1] + 1 + begin, broken[start] + lines))
        begin, lines = end, lines + int(broken[-1])
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else tuple(np.zeros(0, dtype=np.int64) for _ in range(4))


# The labelled table

def labelled_table(seed: int = 11, rows: int = 700) -> list[list[tuple[str, str]]]:
    """Rows of (text, kind) parts made by rule: filler words around at most two items, personal or not."""
    rng = random.Random(seed)
    digits = lambda n: "".join(rng.choice(string.digits) for _ in range(n))
    syllables = "an the re ti on ed ion la der ung que eau os ci ón é ä men to st wh".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    octet = lambda: str(rng.randint(0, 255))
    items = {
        "email": lambda: rng.choice([f"{word()}.{digits(2)}@{word()}{digits(1)}.example.com", f"{word()}@{word()}.org", f"{word()} [at] {word()} [dot] com", f"{word()}_{digits(2)} (at) {word()}.net", f"{word()}@{word()}.{word()}.fr"]),
        "ip": lambda: ".".join(octet() for _ in range(4)),
        "card": lambda: rng.choice([digits(16), digits(16), " ".join(digits(4) for _ in range(4)), "-".join(digits(4) for _ in range(4)), f"{digits(4)} {digits(6)} {digits(5)}"]),
        "phone": lambda: rng.choice([f"+1 ({digits(3)}) 555-{digits(4)}", f"({digits(3)}) 555-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}", f"+{digits(2)} {digits(2)} {digits(4)} {digits(4)}", f"+{digits(2)} {digits(3)} {digits(3)} {digits(3)}"]),
        "secret": lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([32, 40, 40, 64]))),
    }
    plain = [
        lambda: str(rng.randint(1900, 2030)), lambda: f"{rng.randint(1, 12)}.{rng.randint(0, 20)}.{rng.randint(0, 9)}", lambda: f"{digits(1)}.{digits(1)}", lambda: f"CC BY-NC {digits(1)}.0", lambda: f"version {digits(1)}.{digits(1)}", lambda: f"{rng.randint(1, 28)}/{rng.randint(1, 12)}/{rng.randint(1950, 2030)}",
        lambda: f"{rng.randint(1950, 2030)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}", lambda: f"{rng.randint(1, 23)}:{digits(2)}", lambda: f"$ {digits(2)},{digits(3)}", lambda: f"{digits(2)} %", lambda: f"page {digits(3)}", lambda: f"{digits(5)}", lambda: f"{digits(7)}", lambda: f"({digits(1)})", lambda: f"{digits(3)} {digits(3)}", lambda: f"ISBN 978-{digits(1)}-{digits(4)}-{digits(4)}-{digits(1)}",
        lambda: " ".join(digits(rng.randint(1, 3)) for _ in range(rng.randint(3, 9))), lambda: f"@ {word()}", lambda: f"Section {digits(1)}.{digits(1)}.{digits(1)}", lambda: f"{digits(1)}. {word()}",
    ]
    out = []
    for _ in range(rows):
        row: list[tuple[str, str]] = []
        for _ in range(rng.choice([1, 1, 2])):
            row.append((" ".join(word() + rng.choice(["", "", "", ",", "."]) for _ in range(rng.randint(0, 6))), "O"))
            kind = rng.choice([*items, "O", "O", "O"])
            if kind == "secret" and rng.random() < 0.8:
                row += [(rng.choice(['token = "', "key: ", 'secret="', "password ", 'api_key = "']), "O"), (items[kind](), kind), ('"', "O")]
            else:
                row.append((rng.choice(plain)() if kind == "O" else items[kind](), kind))
        row.append((" ".join(word() for _ in range(rng.randint(0, 5))), "O"))
        out.append([x for x in row if x[0]])
    return out


def labelled_tokens(row: list[tuple[str, str]]) -> tuple[list[tuple[str, int, int]], list[int]]:
    text, spans = "", []
    for part, kind in row:
        text += " " if text and not text.endswith(('"', " ")) and part != '"' else ""
        if kind != "O":
            spans.append((kind, len(text), len(text) + len(part)))
        text += part
    tokens = [(m[0], *m.span()) for m in TOKEN.finditer(text)]
    labels = []
    for _, s, e in tokens:
        own = next(((k, a) for k, a, b in spans if a <= s and e <= b), None)
        labels.append(LABELS.index(f"{'B' if s == own[1] else 'I'}-{own[0]}") if own else 0)
    return tokens, labels


# The field

#: An I follows a label of its own kind only, and stands never first.
FOLLOWS = np.array([[0 if b[0] == "I" and a[2:] != b[2:] else 1 for b in LABELS] for a in LABELS])
STARTS = np.array([0 if x[0] == "I" else 1 for x in LABELS])
NEVER = -1e9


class Field:
    """Weights of a linear-chain field: one for each (feature, label) and each (label, label)."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, moves: np.ndarray):
        self.index, self.weights, self.moves = index, weights, moves
        self.codes, self.seen = Vocabulary(), {}
        self.scores, self.gains = np.zeros((0, len(LABELS))), np.zeros(0)
        # by how much moves may gain, at most: into and out of a span, and from one token of it to the next
        kinds = [(LABELS.index(f"B-{k}"), LABELS.index(f"I-{k}")) for k in MORE_KINDS]
        begins, insides = [b for b, _ in kinds], [b for pair in kinds for b in pair]
        enter = max(0.0, (moves[:, begins] - moves[:, :1]).max())
        leave = max(0.0, (moves[np.ix_(insides, [0, *begins])] - moves[:1, [0, *begins]]).max())
        self.step = max(moves[x, i] for b, i in kinds for x in (b, i)) - moves[0, 0]
        self.ends = enter + leave - self.step

    def __reduce__(self):
        return Field, (self.index, self.weights, self.moves)

    def known(self, keys: np.ndarray) -> np.ndarray:
        """The rows of scores of patterns of shapes; those that are new are made."""
        if len(self.seen) > PATTERNS:
            self.seen, self.scores, self.gains = {}, self.scores[:0], self.gains[:0]
        new = [k for k in keys.tolist() if k not in self.seen]
        if new:
            shapes, gaps = self.codes.shapes, ("", "_", "|")
            rows = self.local([pattern(*(shapes[k >> 7 * i & 127] for i in range(5)), gaps[k >> 35 & 3], gaps[k >> 37]) for k in new])
            self.seen.update(zip(new, range(len(self.scores), len(self.scores) + len(new)), strict=True))
            self.scores, self.gains = np.concatenate((self.scores, rows)), np.concatenate((self.gains, rows[:, 1:].max(axis=1) - rows[:, 0]))
        return np.array([self.seen[k] for k in keys.tolist()], dtype=np.int64)

    def spans(self, text: str) -> list[Span]:
        """The spans of the likeliest labels of each line."""
        code, start, end, line = tokens_of(text, self.codes)
        n = len(code)
        if not n:
            return []
        # two empty places between lines would do the same as these masks, for more memory
        same1 = np.concatenate(([False], line[1:] == line[:-1], [False]))  # [i]: the tokens i - 1 and i share a line
        same2 = np.concatenate(([False, False], line[2:] == line[:-2], [False, False]))[: n + 2]  # [i]: i - 2 and i do
        c = np.concatenate(([0, 0], code & 127, [0, 0]))
        gap = np.concatenate(([2], np.where(same1[1:n], start[1:] > end[:-1], 2), [2]))
        a = np.where(same2[:n], c[:n], np.where(same1[:n], 0, 1))
        b = np.where(same1[:n], c[1 : n + 1], 0)
        d = np.where(same1[1:], c[3 : n + 3], 2)
        e = np.where(same2[2:], c[4:], np.where(same1[1:], 2, 3))
        keys, of = np.unique(a | b << 7 | c[2 : n + 2] << 14 | d << 21 | e << 28 | gap[:n] << 35 | gap[1:] << 37, return_inverse=True)
        row = self.known(keys)[of]
        gain, more, at = self.gains[row], np.zeros((0, len(LABELS))), np.zeros(0, dtype=np.int64)
        cues = np.flatnonzero(code >> 7)
        if len(cues):  # what cue words add to the tokens around them
            to, feature = [], []
            for k in range(-4, 3):
                near = cues[(cues - k >= 0) & (cues - k < n)]
                near = near[line[near] == line[near - k]]
                to.append(near - k)
                feature.append((k + 4) * len(self.codes.cues) + (code[near] >> 7))
            to, feature = np.concatenate(to), np.concatenate(feature)
            at, of = np.unique(to, return_inverse=True)
            more = self.scores[row[at]].copy()
            np.add.at(more, of, self.cue_scores()[feature])
            gain[at] = more[:, 1:].max(axis=1) - more[:, 0]
        total = np.concatenate(([0.0], np.cumsum(gain + self.step)))
        most = np.maximum.accumulate(total[::-1])[::-1][1:] - np.minimum.accumulate(total)[:-1]  # of all spans over a token, lines taken for one
        open_ = np.flatnonzero(most + self.ends > -1e-6)
        if not len(open_):
            return []
        return self.settle(open_, self.scores[row[open_]], more, at, line, start, end)

    def settle(self, open_: np.ndarray, local: np.ndarray, more: np.ndarray, at: np.ndarray, line: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[Span]:
        """Viterbi over the tokens that may be inside a span; in a line, those beside them are outside."""
        if len(at):
            where = np.minimum(np.searchsorted(at, open_), len(at) - 1)
            local = np.where((at[where] == open_)[:, None], more[where], local)
        cuts = np.flatnonzero((np.diff(open_) > 1) | (line[open_[1:]] != line[open_[:-1]])) + 1
        outside = np.full((1, len(LABELS)), NEVER)
        outside[0, 0] = 0
        pieces = []  # places in open_, whether an outside token stands before, scores
        for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(open_)], strict=True):
            i, j = open_[x], open_[y - 1]
            before, behind = int(i > 0 and line[i - 1] == line[i]), int(j + 1 < len(line) and line[j + 1] == line[j])
            pieces.append((x, y, before, np.concatenate([*[outside] * before, local[x:y], *[outside] * behind])))
        pieces.sort(key=lambda p: len(p[3]))
        labels = np.zeros(len(open_), dtype=np.int64)
        begin = 0
        while begin < len(pieces):
            stop = begin + 1
            while stop < len(pieces) and (stop - begin + 1) * len(pieces[stop][3]) <= BATCH:
                stop += 1
            for (x, y, before, _), found in zip(pieces[begin:stop], self.viterbi([p[3] for p in pieces[begin:stop]]), strict=True):
                labels[x:y] = found[before : before + y - x]
            begin = stop
        out: list[Span] = []
        for p in np.flatnonzero(labels).tolist():
            name, i = LABELS[labels[p]], open_[p]
            if name[0] == "B":
                out.append((name[2:], int(start[i]), int(end[i])))
            else:  # follows its own kind in this line
                out[-1] = (*out[-1][:2], int(end[i]))
        return out

    def cue_scores(self) -> np.ndarray:
        """(place from -4 to 2 and cue, labels): weights of the cue features."""
        out = np.zeros((7 * len(self.codes.cues), len(LABELS)))
        for k in range(7):
            for i, cue in enumerate(self.codes.cues):
                if (f := self.index.get(f"cue{k - 4}:{cue}")) is not None:
                    out[k * len(self.codes.cues) + i] = self.weights[f]
        return out

    def local(self, tokens: list[list[str]]) -> np.ndarray:
        """(tokens, labels): the sums of the weights of each token's features. Unknown features count for nothing."""
        flat = [[self.index[f] for f in t if f in self.index] for t in tokens]
        ends = np.cumsum([len(t) for t in flat])
        return np.add.reduceat(self.weights[np.array([i for t in flat for i in t], dtype=np.int64)], np.concatenate(([0], ends[:-1])), axis=0)  # each has the bias at least

    def viterbi(self, local: list[np.ndarray]) -> list[list[int]]:
        """The likeliest labels of each row of scores, over all rows at once."""
        n = np.array([len(x) for x in local])
        scores = np.zeros((len(local), n.max(), len(LABELS)))
        for row, x in zip(scores, local, strict=True):
            row[: len(x)] = x
        moves = np.where(FOLLOWS > 0, self.moves, NEVER)
        best, back = np.where(STARTS > 0, scores[:, 0], NEVER), np.zeros(scores.shape, dtype=np.int8)
        for t in range(1, scores.shape[1]):
            step = best[:, :, None] + moves
            back[:, t] = step.argmax(axis=1)
            best = np.where((t < n)[:, None], step.max(axis=1) + scores[:, t], best)
        out, at = np.zeros(scores.shape[:2], dtype=np.int64), best.argmax(axis=1)
        for t in range(scores.shape[1] - 1, -1, -1):
            out[:, t] = at
            at = np.where((0 < t) & (t < n), np.take_along_axis(back[:, t], at[:, None].astype(np.int64), axis=1)[:, 0], at)
        return [r[:k].tolist() for r, k in zip(out, n.tolist(), strict=True)]

    def decode(self, rows: list[list[list[str]]]) -> list[list[int]]:
        """The likeliest labels of rows given by their features."""
        return self.viterbi([self.local(r) for r in rows])

    def label(self, rows: list[list[tuple[str, int, int]]]) -> list[list[int]]:
        """The likeliest labels of rows of tokens; the features of PART tokens are held at once."""
        held, own, parts = [], [], [[] for _ in rows]

        def settle() -> None:
            if held:
                scores, begin = self.local(held), 0
                for i, k in own:
                    parts[i].append(scores[begin : begin + k])
                    begin += k
                held.clear()
                own.clear()

        for i, tokens in enumerate(rows):
            for begin in range(0, len(tokens), PART):
                end = min(len(tokens), begin + PART)
                held.extend(features(tokens, begin, end))
                own.append((i, end - begin))
                if len(held) >= PART:
                    settle()
        settle()
        return self.viterbi([np.concatenate(x) for x in parts])


def train(rows: list[tuple[list[list[str]], list[int]]], rounds: int = 80, rate: float = 0.15, l2: float = 0.02) -> Field:
    """Maximum conditional likelihood by full-batch gradients (scaled forward-backward, Adam)."""
    index: dict[str, int] = {}
    for r, _ in rows:
        for t in r:
            for f in t:
                index.setdefault(f, len(index))
    size, n = len(LABELS), np.array([len(r) for r, _ in rows])
    most = n.max()
    inside = np.arange(most) < n[:, None]
    tokens = [t for r, _ in rows for t in r]
    ids = np.array([index[f] for t in tokens for f in t])
    token_of = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
    token_at = np.concatenate(([0], np.cumsum([len(t) for t in tokens])[:-1]))
    by_id = np.argsort(ids, kind="stable")
    id_at = np.searchsorted(ids[by_id], np.arange(len(index)))
    gold, gold_moves = np.eye(size)[np.array([y for _, ys in rows for y in ys])], np.zeros((size, size))
    for _, y in rows:
        np.add.at(gold_moves, (y[:-1], y[1:]), 1)
    field = Field(index, np.zeros((len(index), size)), np.zeros((size, size)))
    state = [np.zeros_like(x) for x in (field.weights, field.weights, field.moves, field.moves)]
    for step in range(1, rounds + 1):
        scores = np.zeros((len(rows), most, size))
        scores[inside] = np.add.reduceat(field.weights[ids], token_at, axis=0)
        local, moves = np.exp(scores - scores.max(axis=2, keepdims=True)), np.exp(field.moves) * FOLLOWS
        ahead, behind, scale = np.zeros_like(local), np.ones_like(local), np.ones((len(rows), most))
        for t in range(most):
            now = local[:, t] * (ahead[:, t - 1] @ moves if t else STARTS)
            scale[:, t] = now.sum(axis=1)
            ahead[:, t] = now / scale[:, t, None]
        for t in range(most - 2, -1, -1):
            behind[:, t] = np.where(inside[:, t + 1, None], (local[:, t + 1] * behind[:, t + 1]) @ moves.T / scale[:, t + 1, None], 1.0)
        after = np.where(inside[:, 1:, None], local[:, 1:] * behind[:, 1:] / scale[:, 1:, None], 0.0)
        pairs = np.tensordot(ahead[:, :-1], after, axes=((0, 1), (0, 1))) * moves
        rest = (gold - (ahead * behind)[inside])[token_of[by_id]]
        grad = np.add.reduceat(rest, id_at, axis=0) - l2 * field.weights
        for x, g, m, v in ((field.weights, grad, state[0], state[1]), (field.moves, gold_moves - pairs - l2 * field.moves, state[2], state[3])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return field


@lru_cache(maxsize=1)
def trained() -> Field:
    rows = []
    for row in labelled_table():
        tokens, labels = labelled_tokens(row)
        rows.append((features(tokens), labels))
    return train(rows)


def field_spans(texts: list[str], field: Field) -> list[list[Span]]:
    """What the field finds in each text, in order, over all tokens of every line. A span lies within a line. Short texts are taken together."""
    out: list[list[Span]] = [[] for _ in texts]
    begin = 0
    while begin < len(texts):
        end, held = begin + 1, len(texts[begin])
        while end < len(texts) and held + len(texts[end]) <= GROUP:
            held += len(texts[end]) + 1
            end += 1
        first = np.cumsum([0, *(len(t) + 1 for t in texts[begin : end - 1])])
        for kind, s, e in field.spans("\n".join(texts[begin:end])):
            i = int(np.searchsorted(first, s, side="right")) - 1
            out[begin + i].append((kind, s - int(first[i]), e - int(first[i])))
        begin = end
    return out


def sound(kind: str, found: str) -> bool:
    """Whether a number that the field calls a card passes the checksum, an address has four parts up to 255, and a mail address an at and a dot behind it."""
    if kind == "email":
        return MAIL.search(found) is not None
    parts = DIGITS.findall(found)
    if kind == "card":
        return 12 <= sum(map(len, parts)) <= 19 and luhn("".join(parts))
    return kind != "ip" or len(parts) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in parts)


def all_spans(texts: list[str], field: Field) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text. The field's spans that touch a base span are left out, and so are its cards and addresses that can't be such."""
    out = []
    for text, more in zip(texts, field_spans(texts, field), strict=True):
        base = base_spans(text)
        taken = sorted((s, e) for _, s, e in base)
        new, k, reach = [], 0, 0
        for span in sorted(more, key=lambda m: m[1]):
            while k < len(taken) and taken[k][0] < span[2]:
                reach, k = max(reach, taken[k][1]), k + 1
            if reach <= span[1] and sound(span[0], text[span[1] : span[2]]):
                new.append(span)
        out.append((base, in_order([*base, *new])))
    return out


def find(docs: DataFrame) -> DataFrame:
    """doc_id, the numbers of base spans of each kind, base_sha256 and spans of each row."""
    field = trained()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = all_spans([t or "" for t in batch.column("text").to_pylist()], field)
        counts = [pa.array([sum(s[0] == k for s in base) for base, _ in rows], pa.int64()) for k in KINDS]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b, _ in rows]), pa.array([written(a) for _, a in rows])], names=names)

    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    return map_slices(docs.select("doc_id", "text"), "text", run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span (overlapping ones together, under the first one's kind) replaced by its kind in brackets."""
    out, at = [], 0
    merged: list[list] = []
    for kind, s, e in sorted(spans, key=lambda x: x[1]):
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([kind, s, e])
    for kind, s, e in merged:
        out += [text[at:s], f"[{kind.upper()}]"]
        at = e
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """docs with personal data replaced in text; n_chars, if there, is counted anew. Null texts stay null."""
    field, schema = trained(), docs.schema

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        new = [None if t is None else redacted(t, spans) for t, (_, spans) in zip(texts, all_spans([t or "" for t in texts], field), strict=True)]
        cols = []
        for name, col in zip(batch.schema.names, batch.columns, strict=True):
            cols.append(pa.array(new, col.type) if name == "text" else pa.array([None if t is None else len(t) for t in new], col.type) if name == "n_chars" else col)
        return pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

    return map_slices(docs, "text", run, schema)


def op1_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))
