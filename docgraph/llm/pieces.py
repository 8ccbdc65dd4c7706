"""SentencePiece encoding and decoding: Viterbi over a double-array trie of scored pieces.

A text is encoded as its UTF-8 bytes with one space in front; pieces write a space as the marker
U+2581 (here kept as a space). The encoding is the sequence of pieces with the highest sum of
scores; a character that no piece covers costs ``UNKNOWN`` and becomes byte pieces, and so does a
literal marker character, so that decoding gives the text back exactly. No piece has a marker
after another character and none has a line end, so the best sequence of a text is the
concatenation of the best sequences of its parts; a batch computes each distinct part once, all
parts of a batch side by side.
"""

from __future__ import annotations

import functools
import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docgraph.llm import kernel as K
from docgraph.llm.frames import each, pair

MARKER = "▁".encode()
#: Below the worst piece, as in unigram models with byte fallback.
UNKNOWN = 10.0
#: The place of the vocabulary (a parameter of every operator here).
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text whose distinct parts are encoded together.
CHUNK = 1 << 19
#: Parts of a text: a word with the spaces before it, spaces alone, or a line end.
PARTS = re.compile(rb" *[^ \n]+| +|\n")


@dataclass
class Vocabulary:
    """Pieces with scores as a double-array trie over bytes."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray  # piece id at a trie state, or -1
    score: np.ndarray  # by piece id
    length: np.ndarray  # bytes, by piece id
    bytes: np.ndarray  # piece id of each byte value
    text: list[bytes]  # by piece id
    unknown: float


def double_array(words: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base, check and value arrays; state 1 is the root, check of an unused state is 0.

    A base may be negative; a step to a negative place ends at an unused state at the end.
    """
    children: list[dict[int, int]] = [{}]
    value = [-1]
    for word, i in words:
        node = 0
        for c in word:
            node = children[node].setdefault(c, len(children))
            if node == len(children):
                children.append({})
                value.append(-1)
        value[node] = i
    size = 4 * len(children) + 1024
    base, check, out = (np.zeros(size, np.int32) for _ in range(3))
    out[:] = -1
    used = np.zeros(size, bool)
    used[:2] = True
    check[1] = 1
    state = np.zeros(len(children), np.int64)
    state[0] = 1
    out[1] = value[0]
    free, tail = 2, 2  # single children fill the gaps that groups of children leave
    order = [0]
    for node in order:
        own = children[node]
        if not own:
            continue
        codes = np.array(sorted(own)) + 1
        while used[free]:
            free += 1
        b = (free if len(codes) == 1 else tail) - int(codes[0])
        while used[b + codes].any():
            b += 1
        if len(codes) > 1:
            tail = max(tail, b + int(codes[0]) - 64)
        base[state[node]] = b
        used[b + codes] = True
        check[b + codes] = state[node]
        for c, child in sorted(own.items()):
            state[child] = b + c + 1
            out[state[child]] = value[child]
            order.append(child)
    return base, check, out


@functools.cache
def vocabulary(path: str = MODEL, unigram: bool = False) -> Vocabulary:
    """Read a model file. With ``unigram`` the scores of the file are log-probabilities; the
    scores of a merge model are ranks, which become log-probabilities by Zipf's law."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    text, bytes_, usable = [], np.full(256, -1), []
    for i in range(n):
        piece = model.id_to_piece(i).encode().replace(MARKER, b" ")
        if model.is_byte(i):
            piece = bytes([int(piece[3:5], 16)])
            bytes_[piece[0]] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            usable.append(i)
        text.append(piece)
    if (bytes_ < 0).any():
        raise ValueError("the vocabulary has no byte pieces")
    if any(b" " in text[i].lstrip(b" ") or b"\n" in text[i] for i in usable):
        raise ValueError("a piece has a marker behind another character, or a line end")
    raw = np.array([model.get_score(i) for i in usable])
    if not unigram:
        rank = np.argsort(np.argsort(-raw, kind="stable"))
        raw = -np.log((rank + 1) * np.log(len(usable) + 1))
    score = np.full(n, -np.inf)
    score[usable] = raw
    base, check, value = double_array([(text[i], i) for i in usable])
    return Vocabulary(base, check, value, score, np.array([len(t) for t in text]), bytes_, text,
                      float(raw.min()) - UNKNOWN)


def viterbi(v: Vocabulary, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the best sequence of every part, end to end, and each part's offsets.

    Of sequences with equal scores the one whose last differing piece is longer wins.
    """
    size = np.array([len(p) for p in parts], np.int64)
    end = np.cumsum(size)
    begin = end - size
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.int32)
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(len(parts) + 1, np.int64)
    limit = np.repeat(end.astype(np.int32), size)
    char = np.flatnonzero((data & 0xC0) != 0x80).astype(np.int32)
    width = np.diff(np.append(char, n)).astype(np.int32)
    single = np.zeros(n, bool)  # characters that are a piece of their own
    edges = []
    at, state, depth = char, np.ones(len(char), np.int32), 0
    while len(at):
        step = v.base[state] + data[at + depth] + 1
        ok = (v.check[np.minimum(step, len(v.check) - 1)] == state) & (step < len(v.check))
        at, state, depth = at[ok], step[ok], depth + 1
        piece = v.value[state]
        hit = piece >= 0
        edges.append((at[hit], np.full(hit.sum(), depth, np.int32), piece[hit]))
        more = at + depth < limit[at]
        at, state = at[more], state[more]
    start, length, piece = (np.concatenate(x) for x in zip(*edges))
    wide = np.zeros(n, np.int32)
    wide[char] = width
    single[start[length == wide[start]]] = True
    lone = char[~single[char]]
    start = np.concatenate((start, lone))
    length = np.concatenate((length, wide[lone]))
    cost = np.concatenate((v.score[piece], np.full(len(lone), v.unknown)))
    piece = np.concatenate((piece, np.full(len(lone), -1, np.int32)))

    offset = start - np.repeat(begin, size)[start]
    if size.max() < 1 << 16:
        offset = offset.astype(np.uint16)  # sorted by digits
    order = np.argsort(offset, kind="stable")
    start, length, cost, piece = start[order], length[order], cost[order], piece[order]
    cuts = np.flatnonzero(np.diff(offset[order])) + 1
    # Node k of a part lies at its first byte + k + number of the part: one more than its bytes.
    shift = np.repeat(np.arange(len(parts), dtype=np.int32), size)
    source, target = start + shift[start], start + shift[start] + length
    best = np.full(n + len(parts), -np.inf)
    best[begin + np.arange(len(parts))] = 0.0
    back = np.full(n + len(parts), -1)
    for a, b in zip(np.append(0, cuts), np.append(cuts, len(start))):
        score = best[source[a:b]] + cost[a:b]
        better = score > best[target[a:b]]
        best[target[a:b][better]] = score[better]
        back[target[a:b][better]] = np.arange(a, b)[better]

    node, first = end + np.arange(len(parts)), begin + np.arange(len(parts))
    chosen = []
    while True:
        live = node > first
        if not live.any():
            break
        node, first = node[live], first[live]
        edge = back[node]
        chosen.append(edge)
        node = source[edge]
    edge = np.concatenate(chosen)
    edge = edge[np.argsort(start[edge], kind="stable")]
    raw = piece[edge] < 0
    count = np.where(raw, length[edge], 1)
    total = np.cumsum(count)
    ids = np.repeat(piece[edge], count)
    place = np.repeat(start[edge], count) + np.arange(len(ids)) - np.repeat(total - count, count)
    byte = ids < 0
    ids[byte] = v.bytes[data[place[byte]]]
    sizes = np.zeros(len(parts) + 1, np.int64)
    np.add.at(sizes, shift[start[edge]] + 1, count)
    return ids, np.cumsum(sizes)


class _Index(dict):
    def __missing__(self, key):
        self[key] = place = len(self)
        return place


def encoded(v: Vocabulary, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, end to end, and each text's offsets."""
    index = _Index()
    codes = [list(map(index.__getitem__, PARTS.findall(b" " + t))) if t else [] for t in texts]
    count = np.array([len(c) for c in codes], np.int64)
    code = np.fromiter((x for c in codes for x in c), np.int64, int(count.sum()))
    flat, offsets = viterbi(v, list(index))
    size = np.diff(offsets)[code] if len(code) else np.zeros(0, np.int64)
    total = np.concatenate(([0], np.cumsum(size)))
    ids = flat[np.repeat(offsets[code] - total[:-1], size) + np.arange(total[-1])]
    return ids, total[np.concatenate(([0], np.cumsum(count)))]


def decoded(v: Vocabulary, ids: list[int]) -> str:
    """The text of a sequence of ids."""
    return b"".join(map(v.text.__getitem__, ids))[1:].decode("utf-8", "replace")


def _shared(df: DataFrame, path: str, unigram: bool):
    return df.sparkSession.sparkContext.broadcast(vocabulary(path, unigram))


def _pieces_of(batch: pa.RecordBatch, size: int):
    """Runs of rows of about ``size`` bytes."""
    for chunk in K.chunks(batch["text"], size):
        raw = chunk.data.tobytes()
        yield chunk, [raw[a:b] for a, b in zip(chunk.starts[:-1], chunk.starts[1:])]


def _rows(v: Vocabulary, batch: pa.RecordBatch):
    """Rows of a batch, a few megabytes of text at a time, with their ids."""
    for chunk, texts in _pieces_of(batch, CHUNK):
        ids, offsets = encoded(v, texts)
        yield batch.slice(chunk.first, chunk.n), texts, K.lists(ids.astype(np.int32), offsets, pa.int32())


def encode(docs: DataFrame, path: str = MODEL, unigram: bool = False, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, text and ids (array of int) per document.

    The driver reads the vocabulary and broadcasts it (its size is the file's). Null and empty texts have no
    ids; repeated rows stay; an empty table gives an empty result.
    """

    shared = _shared(docs, path, unigram)

    def work(batch):
        for rows, _, ids in _rows(shared.value, batch):
            yield {"doc_id": rows["doc_id"], "text": rows["text"], "ids": ids}

    return each(pair(docs, id_col, text_col), work, "doc_id long, text string, ids array<int>")


def decode(rows: DataFrame, path: str = MODEL, unigram: bool = False) -> DataFrame:
    """doc_id, ids and the decoded text (empty without ids); other columns are not kept."""

    shared = _shared(rows, path, unigram)

    def work(batch):
        v = shared.value
        yield {"doc_id": batch["doc_id"], "ids": batch["ids"],
               "decoded": [decoded(v, x.values.to_pylist() if x.is_valid else [])
                           for x in batch["ids"]]}

    return each(rows.select("doc_id", "ids"), work, "doc_id long, ids array<int>, decoded string")


def round_trip(docs: DataFrame, path: str = MODEL, unigram: bool = False,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, n_tokens, n_byte_tokens, ids_sha256 (of 32-bit little-endian ids) and
    round_trip: whether decoding the ids gives the text back (a null text counts as empty)."""

    shared = _shared(docs, path, unigram)

    def work(batch):
        v = shared.value
        raw = np.zeros(len(v.text), bool)
        raw[v.bytes] = True
        for rows, texts, lists in _rows(v, batch):
            out = {k: [] for k in ("n_tokens", "n_byte_tokens", "ids_sha256", "round_trip")}
            for text, ids in zip(texts, lists):
                own = ids.values.to_numpy().astype("<i4")
                out["n_tokens"].append(len(own))
                out["n_byte_tokens"].append(int(raw[own].sum()))
                out["ids_sha256"].append(hashlib.sha256(own.tobytes()).hexdigest())
                out["round_trip"].append(decoded(v, own.tolist()) == text.decode())
            yield {"doc_id": rows["doc_id"], "ids": lists, **out}

    return each(pair(docs, id_col, text_col), work,
                "doc_id long, ids array<int>, n_tokens long, n_byte_tokens long, "
                "ids_sha256 string, round_trip boolean")
