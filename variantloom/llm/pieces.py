"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

The vocabulary is a public BPE model with byte fallback, read from a path that is a parameter. A text is a blank and
the text itself; it falls into units (a run of blanks and what follows up to the next blank) that no piece crosses.
Each unit's merge agenda takes the best-scored adjacent pair, leftmost of equals, again and again. A candidate merge
is skipped for good when a hash keyed by (seed, text, unit's place in the text, place in the unit, piece) falls below the dropout rate, so every
occurrence of a word has a segmentation of its own, all from merges and all decoding to the same text. Rate 0 gives the model's ordinary encoding.

Distinct units of a batch run their agendas without dropout first, side by side in numpy, and keep what candidates they met. An occurrence that
drops none of these has that segmentation; the others run agendas of their own. Units of over LONGEST letters run one by one on a heap, with the same rule.

Edge cases: null text has null pieces and decodes to null; empty text has none and decodes to the empty text; a blank
mark (U+2581) in a text is encoded by its bytes, so that it returns as itself; letters outside the vocabulary are
bytes; repeated rows are encoded alike; other columns stay; very long texts and units are encoded whole.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from .common import given_back, mixed, text_blocks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNIT = re.compile(r" *[^ ]+| +")
MARK = "▁"
LONGEST = 32
NONE = np.int32(1 << 30)


class Pieces:
    """The pieces of a model as arrays: merges, scores and bytes."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        names = [model.id_to_piece(k) for k in range(n)]
        special = [model.is_control(k) or model.is_unknown(k) or model.is_unused(k) for k in range(n)]
        self.byte = [next(k for k in range(n) if model.is_byte(k) and names[k] == f"<0x{b:02X}>") for b in range(256)]
        ids = {x: k for k, x in enumerate(names) if not special[k] and not model.is_byte(k)}
        self.letters = {x: k for x, k in ids.items() if len(x) == 1}
        codes = {ord(x): k for x, k in self.letters.items() if x != MARK} | ({ord(" "): self.letters[MARK]} if MARK in self.letters else {})
        self.by_code = np.full(max(codes, default=0) + 2, -1, dtype=np.int32)  # the piece of each letter; the last place is for all beyond
        self.by_code[list(codes)] = list(codes.values())
        scores = np.array([model.get_score(k) for k in range(n)])
        _, order = np.unique(-scores, return_inverse=True)
        self.rank = order.astype(np.int32)  # a smaller rank merges first
        self.bytes = [b"" if special[k] else bytes([int(x[3:5], 16)]) if model.is_byte(k) else x.replace(MARK, " ").encode() for k, x in enumerate(names)]
        keys, values = [], []
        for x, k in ids.items():
            for cut in range(1, len(x)):
                if x[:cut] in ids and x[cut:] in ids:
                    keys.append(ids[x[:cut]] << 32 | ids[x[cut:]])
                    values.append(k)
        self.pairs = dict(zip(keys, values, strict=True))
        # open addressing, so that many pairs are looked up at once
        size = 1 << 20
        self.slots, self.found = np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.int32)
        keys, values = np.array(keys, dtype=np.int64), np.array(values, dtype=np.int32)
        at = self.slot(keys)
        while len(keys):
            free = self.slots[at] < 0
            _, first = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)
            first = first[free[first]]
            self.slots[at[first]], self.found[at[first]] = keys[first], values[first]
            rest = np.ones(len(keys), dtype=bool)
            rest[first] = False
            keys, values, at = keys[rest], values[rest], (at[rest] + 1) & (size - 1)

    @staticmethod
    def slot(keys: np.ndarray) -> np.ndarray:
        return (mixed(keys.view(np.uint64)) >> np.uint64(44)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece of each pair, or -1."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        out = np.full(len(keys), -1, dtype=np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        at = self.slot(keys[todo])
        while len(todo):
            seen = self.slots[at]
            hit = seen == keys[todo]
            out[todo[hit]] = self.found[at[hit]]
            on = ~hit & (seen >= 0)
            todo, at = todo[on], (at[on] + 1) & (len(self.slots) - 1)
        return out

    def symbols_of(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """`symbols` of many units, flat, and how many each has: all letters are looked up at once, only those without a piece one by one."""
        letters = "".join(units)
        codes = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ids = self.by_code[np.minimum(codes, len(self.by_code) - 1)]
        ends = np.cumsum(np.fromiter(map(len, units), dtype=np.int64, count=len(units)))
        odd = np.flatnonzero(ids < 0)
        each = [self.symbols(letters[k]) for k in odd.tolist()]
        wide = np.ones(len(ids), dtype=np.int64)
        wide[odd] = [len(x) for x in each]
        flat = np.repeat(ids, wide)
        flat[flat < 0] = np.fromiter(chain.from_iterable(each), dtype=np.int32)
        return flat, np.diff(np.concatenate([[0], np.cumsum(wide)])[np.concatenate([[0], ends])])

    def symbols(self, unit: str) -> list[int]:
        """A piece per letter; letters without one, and blank marks of the text, are their bytes, which never merge."""
        out = []
        for c in unit:
            k = self.letters.get(MARK if c == " " else c, -1) if c != MARK else -1
            out += [k] if k >= 0 else [self.byte[b] for b in c.encode("utf-8", "surrogatepass")]
        return out


def skipped(key: np.ndarray, place: np.ndarray, piece: np.ndarray, rate: float) -> np.ndarray:
    """Whether the candidate merge into `piece` at `place` is dropped; key holds seed, text and the unit's place."""
    h = mixed(key ^ mixed(place.astype(np.uint64) << np.uint64(32) | piece.astype(np.uint64)))
    return (h >> np.uint64(40)).astype(np.float64) < rate * (1 << 24)


def agenda_one(p: Pieces, ids: list[int], key: int, rate: float) -> list[int]:
    """The agenda of one unit, on a heap."""
    after, before, live = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1)), list(ids)
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(places: list[int]) -> None:
        pairs = [(i, after[i]) for i in places if i >= 0 and after[i] < len(ids)]
        found = [(i, j, p.pairs.get(live[i] << 32 | live[j], -1)) for i, j in pairs]
        found = [x for x in found if x[2] >= 0]
        if not found:
            return
        at, piece = np.array([x[0] for x in found]), np.array([x[2] for x in found])
        drop = skipped(np.uint64(key), at, piece, rate) if rate else np.zeros(len(found), dtype=bool)
        for (i, j, k), gone in zip(found, drop.tolist(), strict=True):
            if not gone:
                heapq.heappush(heap, (int(p.rank[k]), i, live[i], live[j], k))

    offer(list(range(len(ids) - 1)))
    while heap:
        _, i, left, right, k = heapq.heappop(heap)
        j = after[i]
        if live[i] != left or j >= len(ids) or live[j] != right:
            continue
        live[i], live[j] = k, -1
        after[i] = after[j]
        if after[j] < len(ids):
            before[after[j]] = i
        offer([before[i], i])
    return [x for x in live if x >= 0]


def in_rows(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of a flat array as rows, -1 behind their ends."""
    sym = np.full((len(sizes), int(sizes.max(initial=0)) + 1), -1, dtype=np.int32)
    sym[np.arange(sym.shape[1]) < sizes[:, None]] = flat[ranges(starts, sizes)[1]]
    return sym


def side_by_side(units: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Units as rows, -1 behind their ends, and their sizes."""
    sizes = np.array([len(u) for u in units])
    return in_rows(np.fromiter(chain.from_iterable(units), dtype=np.int32), np.cumsum(sizes) - sizes, sizes), sizes


def agenda_many(p: Pieces, sym: np.ndarray, sizes: np.ndarray, keys: np.ndarray, rate: float, met: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The agendas of many units of like length (side_by_side), one merge of each at a time: flat pieces and how many each unit has.

    `met` gets (row, place, piece) of all candidates that were offered and not dropped. sym is used up.
    """
    n, width = len(sym), sym.shape[1] - 1
    after = np.tile(np.arange(1, width + 2, dtype=np.int16), (n, 1))
    before = np.tile(np.arange(-1, width, dtype=np.int16), (n, 1))
    best, into = np.full((n, width), NONE, dtype=np.int32), np.zeros((n, width), dtype=np.int32)

    def offer(rows: np.ndarray, at: np.ndarray) -> None:
        nxt = np.minimum(after[rows, at], width)
        piece = p.merged(sym[rows, at], sym[rows, nxt])
        best[rows, at] = NONE
        ok = np.flatnonzero(piece >= 0)
        rows, at, piece = rows[ok], at[ok], piece[ok]
        if rate:
            ok = np.flatnonzero(~skipped(keys[rows], at, piece, rate))
            rows, at, piece = rows[ok], at[ok], piece[ok]
        if met is not None:
            met.append((rows, at, piece))
        best[rows, at], into[rows, at] = p.rank[piece], piece

    rows, at = np.nonzero(np.arange(width) < sizes[:, None] - 1)
    offer(rows, at)
    live = np.arange(n)
    while len(live):
        at = best[live].argmin(axis=1)
        some = best[live, at] < NONE
        live, at = live[some], at[some]
        if not len(live):
            break
        nxt = after[live, at].astype(np.int64)
        far = after[live, nxt].astype(np.int64)
        sym[live, at], sym[live, nxt] = into[live, at], -1
        best[live, np.minimum(nxt, width - 1)] = np.where(nxt < width, NONE, best[live, np.minimum(nxt, width - 1)])
        after[live, at] = far
        inside = far <= width
        before[live[inside], far[inside]] = at[inside]
        prior = before[live, at].astype(np.int64)
        has = prior >= 0
        offer(np.concatenate([live, live[has]]), np.concatenate([at, prior[has]]))
    kept = sym >= 0
    return sym[kept], kept.sum(axis=1)


class Numbers(dict):
    """Numbers keys in the order in which they come."""

    def __missing__(self, key: str) -> int:
        value = self[key] = len(self)
        return value


CLASSES = ((0, 4), (4, 7), (7, 10), (10, 14), (14, 20), (20, LONGEST))


def ranges(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of a flat array: the run of each member, and where the member lies."""
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, (starts - ends + counts)[owner] + np.arange(ends[-1] if len(ends) else 0)


def dropping(which: np.ndarray, keys: np.ndarray, met: list, n: int, rate: float, some: int = 100_000) -> np.ndarray:
    """Which occurrences drop a candidate that the agenda of their unit met without dropout."""
    unit, place, piece = (np.concatenate([m[k] for m in met]) for k in range(3)) if met else (np.empty(0, np.int64),) * 3
    order = np.argsort(unit, kind="stable")
    place, piece, counts = place[order], piece[order], np.bincount(unit, minlength=n)
    starts = np.cumsum(counts) - counts
    hit = np.zeros(len(which), dtype=bool)
    for k in range(0, len(which), some):
        own = which[k : k + some]
        owner, at = ranges(starts[own], counts[own])
        hit[k + owner[skipped(keys[k + owner], place[at], piece[at], rate)]] = True
    return hit


def encoded(p: Pieces, texts: list[str | None], seed: int, rate: float) -> pa.ListArray:
    """The piece ids of each text."""
    known = Numbers()
    numbered = [np.fromiter(map(known.__getitem__, UNIT.findall(" " + t)), dtype=np.int64) if t else np.empty(0, np.int64) for t in texts]
    sizes = np.array([len(u) for u in numbered], dtype=np.int64)
    which = np.concatenate(numbered) if numbered else np.empty(0, np.int64)
    letters, lengths = p.symbols_of(list(known))
    begins = np.cumsum(lengths) - lengths
    own_letters = lambda k: letters[begins[k] : begins[k] + lengths[k]].tolist()
    flats, counts, slots, met = [], [], [], []
    row, shapes = np.zeros(len(lengths), dtype=np.int64), {}
    for low, high in CLASSES:
        pick = np.flatnonzero((lengths > low) & (lengths <= high))
        if len(pick):
            row[pick] = np.arange(len(pick))
            shapes[low] = in_rows(letters, begins[pick], lengths[pick]), lengths[pick]
            seen: list = []
            flat, count = agenda_many(p, shapes[low][0].copy(), shapes[low][1], row[:0].view(np.uint64), 0.0, seen)
            met += [(pick[r], at, piece) for r, at, piece in seen]
            flats, counts, slots = [*flats, flat], [*counts, count], [*slots, pick]
    for k in np.flatnonzero(lengths > LONGEST).tolist():
        own = agenda_one(p, own_letters(k), 0, 0.0)
        flats, counts, slots = [*flats, np.array(own, dtype=np.int32)], [*counts, np.array([len(own)])], [*slots, np.array([k])]
    back, n = which, len(lengths)
    if rate and len(which):
        text = np.array([xxh64_intdigest((t or "").encode("utf-8", "surrogatepass"), seed) for t in texts], dtype=np.uint64)
        place = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        keys = mixed(np.repeat(text, sizes) + mixed(place.astype(np.uint64)))
        own = np.flatnonzero(dropping(which, keys, met, n, rate) | (lengths[which] > LONGEST))
        back = which.copy()
        back[own] = n + np.arange(len(own))
        long = lengths[which[own]]
        for low, high in CLASSES:
            pick = np.flatnonzero((long > low) & (long <= high))
            for some in np.array_split(pick, max(1, len(pick) // 50_000)):
                if len(some):
                    at = row[which[own[some]]]
                    flat, count = agenda_many(p, shapes[low][0][at], shapes[low][1][at], keys[own[some]], rate)
                    flats, counts, slots = [*flats, flat], [*counts, count], [*slots, n + some]
        for k in np.flatnonzero(long > LONGEST).tolist():
            one = agenda_one(p, own_letters(which[own[k]]), int(keys[own[k]]), rate)
            flats, counts, slots = [*flats, np.array(one, dtype=np.int32)], [*counts, np.array([len(one)])], [*slots, np.array([n + k])]
        n += len(own)
    flat = np.concatenate(flats) if flats else np.empty(0, np.int32)
    count, starts = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    if slots:
        slot, count_ = np.concatenate(slots), np.concatenate(counts)
        count[slot] = count_
        starts[slot] = np.cumsum(count_) - count_
    _, at = ranges(starts[back], count[back])
    offsets = np.concatenate([[0], np.cumsum(count[back])])[np.concatenate([[0], np.cumsum(sizes)])]
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat[at], pa.int32()), mask=pa.array([t is None for t in texts]))


def decoded(p: Pieces, pieces: pa.ListArray) -> list[str | None]:
    """The text of each list of pieces, without the first blank."""
    out: list[str | None] = []
    names = p.bytes
    for own in pieces:
        if not own.is_valid:
            out.append(None)
            continue
        raw = b"".join([names[k] for k in np.asarray(own.values).tolist()])
        out.append(raw[1:].decode("utf-8", "surrogatepass") if raw[:1] == b" " else raw.decode("utf-8", "surrogatepass"))
    return out


def lossless(p: Pieces, texts: list[str | None], ids: pa.ListArray) -> pa.ListArray:
    """The pieces, if they decode to their texts; else an error."""
    if decoded(p, ids) != texts:
        raise ValueError("pieces do not decode to their text")
    return ids


_LOADED: dict[str, Pieces] = {}


def loaded(path: str) -> Pieces:
    """The model, read once in each worker."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def encode(docs: DataFrame, seed: int = 1, rate: float = 0.1, path: str = MODEL) -> DataFrame:
    """docs with all its columns and `pieces`, the ids of each text (a column of that name is replaced)."""
    rest = docs.drop("pieces")
    schema, names = rest.schema, rest.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, 4_000_000):  # the more text at once, the fewer distinct units a byte; more also takes more memory
            ids = encoded(loaded(path), batch.column("text").to_pylist(), seed, rate)
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), ids], [*names, "pieces"])

    return rest.mapInArrow(run, T.StructType([*schema.fields, T.StructField("pieces", T.ArrayType(T.IntegerType()))]))


def decode(rows: DataFrame, path: str = MODEL) -> DataFrame:
    """rows with all its columns and `decoded`, the text of `pieces`."""
    rest = rows.drop("decoded")
    schema, names = rest.schema, rest.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1_000):
                some = batch.slice(k, 1_000)
                texts = decoded(loaded(path), some.column("pieces"))
                yield pa.RecordBatch.from_arrays([*(some.column(x) for x in names), pa.array(texts, pa.string())], [*names, "decoded"])
        given_back()

    return rest.mapInArrow(run, T.StructType([*schema.fields, T.StructField("decoded", T.StringType())]))


def round_trip(docs: DataFrame, seed: int = 1, rate: float = 0.1, path: str = MODEL) -> DataFrame:
    """doc_id, n_pieces, a digest of the pieces, the digest of the decoded text, and whether it is the text."""
    rows = decode(encode(docs.select("doc_id", "text"), seed, rate, path), path)
    return rows.select(
        "doc_id",
        F.coalesce(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_hash"),
        F.sha2(F.coalesce("decoded", F.lit("")), 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )


def encoded_documents(docs: DataFrame, seed: int = 1, rate: float = 0.1, path: str = MODEL) -> DataFrame:
    """doc_id, lang, source, pieces, n_pieces of every text; a text that did not decode to itself would be an error.

    Pieces are decoded where they were made, in the same worker: texts move once, and a task has one worker, not two.
    """
    rest = docs.select("doc_id", "text", "lang", "source")
    kept = [f for f in rest.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, 1_000_000):
            p, texts = loaded(path), batch.column("text").to_pylist()
            ids = lossless(p, texts, encoded(p, texts, seed, rate))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), ids], [*(f.name for f in kept), "pieces"])

    rows = rest.mapInArrow(run, T.StructType([*kept, T.StructField("pieces", T.ArrayType(T.IntegerType()))]))
    return rows.withColumn("n_pieces", F.coalesce(F.size("pieces"), F.lit(0)).cast("long"))
