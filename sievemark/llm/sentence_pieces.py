"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

Spaces become the marker U+2581, one is put in front, and the text is cut into the
pieces of the highest summed log score. A character that no piece covers costs a
penalty below every score and is written as its bytes. Pieces with a marker only
in front never cross from one word into the next, so words are solved on their
own: all new ones of a batch at once in numpy, and each worker keeps what it has
solved. Decoding turns markers into spaces, bytes into text, and drops the space
put in front; a marker that the text itself holds is written as bytes, so decoding
returns every text exactly.

The pieces come from a model file. The scores of a unigram model are log
probabilities; those of a BPE model are negative merge ranks r, for which
-log(r + 2) is taken (Zipf's law).

Defined results: a null text has null ids and decodes to null; an empty text has
no ids. Of equally good cuts that with the longer last piece is taken. Ids outside
the model fail the decoding. Repeated rows are each encoded; other columns pass
through, but for one with the name of the result, which is replaced.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .columns import mapped, quoted
from .double_array import build
from .storage import slices

MARK = "▁"
PENALTY = 10.0
#: Words kept by a worker, the longest kept, bytes of words solved at once,
#: characters of texts encoded at once, ids decoded at once.
KEPT, LONGEST, SOLVED, CHARS, IDS = 300_000, 64, 1 << 17, 1 << 19, 1 << 18
#: Bytes from which a word is solved alone.
LONG = 512
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@dataclass
class Pieces:
    """A model's pieces, ready to be broadcast."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    ids: np.ndarray  # of the trie's keys
    scores: np.ndarray  # of the trie's keys
    byte_ids: np.ndarray
    spelled: list[bytes]  # of every id, markers as spaces
    crossing: bool
    name: str
    known: dict[str, bytes] = field(default_factory=dict)

    def __getstate__(self):
        return self.__dict__ | {"known": {}}


@lru_cache(4)
def load(path: str) -> Pieces:
    """Read a model file on the driver."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.vocab_size()
    text = [model.id_to_piece(i) for i in range(n)]
    plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    spelled = [text[i].replace(MARK, " ").encode() for i in range(n)]
    byte_ids = np.full(256, model.unk_id(), np.int32)
    for i in range(n):
        if model.is_byte(i):
            b = int(text[i][1:-1], 16)
            byte_ids[b], spelled[i] = i, bytes([b])
        elif model.is_control(i):
            spelled[i] = b""
    scores = np.array([model.get_score(i) for i in plain], np.float64)
    if len(scores) and scores.min() < -1000:  # ranks, not logarithms
        scores = -np.log(2.0 - scores)
    return from_pieces([text[i] for i in plain], scores, np.array(plain, np.int32), byte_ids, spelled)


def from_pieces(texts: list[str], scores: np.ndarray, ids: np.ndarray, byte_ids: np.ndarray, spelled: list[bytes]) -> Pieces:
    base, check, value = build([t.encode() for t in texts])
    crossing = any(MARK in t.lstrip(MARK) for t in texts)
    return Pieces(base, check, value, ids, np.asarray(scores, np.float64), byte_ids, spelled, crossing, uuid.uuid4().hex)


def _matches(p: Pieces, data: np.ndarray, ends: np.ndarray, literal: np.ndarray) -> tuple[np.ndarray, ...]:
    """All (start, end, score, key) edges over the bytes of several words; key -1
    is a character written as bytes. ``literal`` marks bytes that no piece may hold."""
    first = np.flatnonzero(((data & 0xC0) != 0x80))
    after = np.append(first[1:], len(data))
    start, end, key = [], [], []
    at, state, depth = first[~literal[first]], None, 0
    state = np.zeros(len(at), np.int64)
    while len(at):
        here = at + depth
        inside = here < ends[at]
        at, state, here = at[inside], state[inside], here[inside]
        to = p.base[state].astype(np.int64) + data[here] + 1
        ok = (p.check[to] == state) & ~literal[here]
        at, state, depth = at[ok], to[ok], depth + 1
        hit = p.value[state] >= 0
        start.append(at[hit])
        end.append(at[hit] + depth)
        key.append(p.value[state[hit]])
    start, end, key = (np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in (start, end, key))
    covered = np.zeros(len(data), bool)
    single = np.zeros(len(data), np.int64)
    single[first] = after
    covered[start[end == single[start]]] = True
    bare = ~covered[first]
    low = (p.scores.min() if len(p.scores) else 0.0) - PENALTY
    start, end = np.concatenate([start, first[bare]]), np.concatenate([end, after[bare]])
    score = np.concatenate([p.scores[key], np.full(int(bare.sum()), low)])
    return start, end, score, np.concatenate([key, np.full(int(bare.sum()), -1, np.int64)])


def _solve_long(p: Pieces, word: bytes) -> bytes:
    """The same for one long word, edge by edge."""
    data = np.frombuffer(word, np.uint8)
    start, end, score, key = _matches(p, data, np.full(len(data), len(data)), np.zeros(len(data), bool))
    order = np.lexsort((start, end))
    reach, back = [0.0] + [-np.inf] * len(data), [0] * (len(data) + 1)
    for i, (s, e, v) in enumerate(zip(start[order].tolist(), end[order].tolist(), score[order].tolist(), strict=True)):
        if reach[s] + v > reach[e]:
            reach[e], back[e] = reach[s] + v, i
    start, key, cut, at = start[order].tolist(), key[order].tolist(), [], len(data)
    while at:
        k, prev = key[back[at]], start[back[at]]
        cut += [int(p.ids[k])] if k >= 0 else p.byte_ids[data[prev:at][::-1]].tolist()
        at = prev
    return np.array(cut[::-1], "<i4").tobytes()


def solve(p: Pieces, words: list[bytes], literal: list[tuple[int, int]] | None = None) -> list[bytes]:
    """Best cut of each word, as little-endian 32-bit ids; literal: byte ranges of
    the joined words that no piece may hold."""
    data = np.frombuffer(b"".join(words), np.uint8)
    lengths = np.array([len(w) for w in words])
    stops = np.cumsum(lengths)
    begin_of, end_of = np.repeat(stops - lengths, lengths), np.repeat(stops, lengths)
    fixed = np.zeros(len(data), bool)
    for a, b in literal or ():
        fixed[a:b] = True
    start, end, score, key = _matches(p, data, end_of, fixed)
    begin = begin_of[start]
    order = np.lexsort((start, end, end - begin))
    start, end, score, key = start[order], end[order], score[order], key[order]
    step = (end - begin[order]).astype(np.int64)
    back = np.zeros(len(data) + 1, np.int64)
    # A word's begin is the end of the word before: its own value there is 0.
    reach = np.zeros(len(data) + 1)
    cuts = np.flatnonzero(np.diff(step, prepend=-1))
    begins = begin[order]
    for a, b in zip(cuts, np.append(cuts[1:], len(step)), strict=True):
        s, e = start[a:b], end[a:b]
        value = np.where(s == begins[a:b], 0.0, reach[s]) + score[a:b]
        heads = np.flatnonzero(np.diff(e, prepend=-1))
        top = np.maximum.reduceat(value, heads)
        runs = np.diff(np.append(heads, b - a))
        first = np.minimum.reduceat(np.where(value == np.repeat(top, runs), np.arange(b - a), b - a), heads)
        reach[e[heads]] = top
        back[e[heads]] = a + first
    # Back from the ends of all words at once; the last step of a word is its first piece.
    word, at, steps = np.arange(len(words)), stops, []
    going = lengths > 0
    while (word := word[going]).size:
        at = at[going]
        edge = back[at]
        steps.append((word, start[edge], at, key[edge]))
        at = start[edge]
        going = at > (stops - lengths)[word]
    if not steps:
        return [b""] * len(words)
    step = np.repeat(np.arange(len(steps)), [len(x[0]) for x in steps])
    word, lo, hi, key = (np.concatenate(x) for x in zip(*steps, strict=True))
    order = np.lexsort((-step, word))
    word, lo, hi, key = word[order], lo[order], hi[order], key[order]
    size = np.where(key >= 0, 1, hi - lo)
    ends = np.cumsum(size)
    found = np.empty(int(ends[-1]), "<i4")
    found[(ends - size)[key >= 0]] = p.ids[key[key >= 0]]
    spelt = np.flatnonzero(key < 0)  # written as bytes
    inner = np.arange(int(size[spelt].sum())) - np.repeat(np.cumsum(size[spelt]) - size[spelt], size[spelt])
    found[np.repeat((ends - size)[spelt], size[spelt]) + inner] = p.byte_ids[data[np.repeat(lo[spelt], size[spelt]) + inner]]
    raw, cuts = found.tobytes(), np.concatenate([[0], np.cumsum(np.bincount(word, size, len(words)))]).astype(np.int64) * 4
    cuts = cuts.tolist()
    return [raw[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]


def _cut(p: Pieces, text: str) -> list[str]:
    marked = MARK + text.replace(" ", MARK)
    return [marked] if p.crossing else _WORD.findall(marked)


def encode_texts(p: Pieces, texts: list[str | None]) -> list[bytes | None]:
    """The ids of each text."""
    known = p.known
    if len(known) > KEPT:
        known.clear()
    cut = [None if not t or MARK in t else _cut(p, t) for t in texts]
    new = sorted(set().union(*filter(None, cut)).difference(known), key=len)  # words of like length take as many steps
    coded = [w.encode("utf-8", "surrogatepass") for w in new]
    long = [w for w, c in zip(new, coded, strict=True) if len(c) > LONG]
    known.update((w, _solve_long(p, w.encode("utf-8", "surrogatepass"))) for w in long)
    new, coded = [w for w, c in zip(new, coded, strict=True) if len(c) <= LONG], [c for c in coded if len(c) <= LONG]
    for i, j in slices(coded, [len(w) for w in coded], SOLVED):
        known.update(zip(new[i:j], solve(p, coded[i:j]), strict=True))
    out: list[bytes | None] = []
    for t, words in zip(texts, cut, strict=True):
        if words:
            out.append(b"".join(map(known.__getitem__, words)))
        elif t:  # holds the marker itself: solved as a whole
            out.append(_with_markers(p, t))
        else:
            out.append(t if t is None else b"")
    for w in [*long, *new]:
        if len(w) > LONGEST:  # long words are not kept beyond their texts
            known.pop(w, None)
    return out


def _with_markers(p: Pieces, text: str) -> bytes:
    """A text that holds the marker itself: those markers go to bytes."""
    parts, literal, at = [MARK.encode()], [], len(MARK.encode())
    for c in re.split(f"({MARK})", text):
        data = c.encode("utf-8", "surrogatepass") if c == MARK else c.replace(" ", MARK).encode("utf-8", "surrogatepass")
        if c == MARK:
            literal.append((at, at + len(data)))
        parts.append(data)
        at += len(data)
    return solve(p, [b"".join(parts)], literal)[0]


def decode_ids(p: Pieces, ids: list[int] | np.ndarray) -> str:
    """The text of a list of ids."""
    data = b"".join(map(p.spelled.__getitem__, ids))
    return data.removeprefix(b" ").decode("utf-8", "replace")


def encode(df: DataFrame, pieces: Pieces, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the ids of ``text`` as array<int> in ``out``."""
    shared = df.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator) -> Iterator:
        for (column,), rest in batches:
            texts = column.to_pylist()
            for i, j in slices(texts, [len(t or "") for t in texts], CHARS):
                ids = encode_texts(shared.value, texts[i:j])
                ends = np.cumsum([0] + [len(x or b"") // 4 for x in ids])
                values = pa.array(np.frombuffer(b"".join(x or b"" for x in ids), "<i4"), pa.int32())
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=pa.array([x is None for x in ids]))
                yield [lists], [c.slice(i, j - i) for c in rest]

    return mapped(df, [quoted(text)], run, [(out, "array<int>")])


def decode(df: DataFrame, pieces: Pieces, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids`` in ``out``."""
    shared = df.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator) -> Iterator:
        for (lists,), rest in batches:
            sizes = np.diff(np.asarray(lists.offsets))
            for i, j in slices(range(len(sizes)), sizes.tolist(), IDS):
                part = lists.slice(i, j - i)
                flat, ends = part.flatten().to_numpy(zero_copy_only=False).tolist(), np.cumsum([0, *sizes[i:j]]).tolist()
                texts = [decode_ids(shared.value, flat[a:b]) if ok else None for a, b, ok in zip(ends, ends[1:], part.is_valid().to_pylist(), strict=False)]
                yield [pa.array(texts, pa.string())], [c.slice(i, j - i) for c in rest]

    return mapped(df, [quoted(ids)], run, [(out, "string")])
