"""Personal data: pattern spans, then information-theoretic sanitisation of terms that give them away.

Base spans are e-mail addresses, IPv4 addresses, card and phone numbers. Protected are each distinct value, what stands
behind it (the user and host of an address, the network, the issuer) and its kind. The corpus tells how strongly a
term reveals an entity: over contexts of distinct texts, PMI(e; t) = log2(p(e, t) / (p(e) p(t))) against the entity's own
information IC(e) = -log2 p(e). The ratio is 1 when the term occurs only with the entity. A context is a stretch of CONTEXT
code points, so that work stays in proportion to the text however many values and terms it holds; a usual document is one.

A pair must be beyond chance, whatever its count: its evidence is n * KL(p(e|t) || p(e)) bits over the n contexts of the term,
and must reach log2(K / alpha), K being the terms that stand with the entity more than once (a Bonferroni bound for each
entity). Of the pairs beyond chance, a ratio of `generalise` (2/3: the term's information is that share of the entity's) has the
term replaced by its shape wherever a text holds the entity too, and a ratio of `remove` has it taken out there. Texts without
a protected value have nothing to disclose and stay as they are.

Counts cover all documents and are exact. Tables that reach the tasks hold one byte or bit for each bucket of hashed terms or
entities; their size follows the number of keys up to a fixed bound. They only let too much pass, never too little, and exact
joins decide.

Edge cases: null text counts as empty; repeated rows and copies get the same spans but count once in the statistics;
null ids are rows like any other; an empty table gives no rows; other columns are ignored; texts are read whole and
every pattern takes time in proportion to the text. Texts are told apart by 128 bits.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import KEYS, bit_words, in_bits, text_blocks, text_keys, text_or_empty, texts_of, written

KINDS = ("email", "ip", "card", "phone", "term")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin where a run of digits does: later starts in the run fail alike
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
WORD = re.compile(r"[^\W\d_]+")
CONTEXT = 4_096
MOST_BUCKETS = 1 << 23
KEY_BITS = 1 << 24
SALTS = 32


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their @ so that long runs cost no more than once."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_SET:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order of start, then kind."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGITS.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(c in "0123456789" for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def entity(text: str) -> int:
    return xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def protected(kind: int, value: str) -> set[int]:
    """What a value reveals: itself, its kind, and who or what is behind it."""
    low = value.lower()
    behind = [f"kind:{KINDS[kind]}", f"{KINDS[kind]}:{low}"]
    if kind == 0:
        user, host = low.split("@", 1)
        behind += [f"user:{user}", f"host:{host}"]
    elif kind == 1:
        behind.append(f"net:{low.rsplit('.', 1)[0]}")
    elif kind == 2:
        behind.append(f"issuer:{''.join(DIGITS.findall(low))[:6]}")
    return {entity(x) for x in behind}


def words_in(text: str, k: int) -> tuple[int, int]:
    """Where the words lie that begin in context k: its borders, moved to the ends of words that they cut."""
    low, high = k * CONTEXT, min(len(text), (k + 1) * CONTEXT)
    if low and WORD.match(text, low - 1) and (m := WORD.match(text, low)):
        low = m.end()
    if high < len(text) and WORD.match(text, high - 1) and (m := WORD.match(text, high)):
        high = m.end()
    return low, max(low, high)


def contexts(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, list[int], list[str]]]:
    """(context, its entities, its terms outside of spans) of every context that holds a value."""
    own: dict[int, set[int]] = {}
    for start, kind, end in spans:
        own.setdefault(start // CONTEXT, set()).update(protected(kind, text[start:end]))
    out = []
    for k, entities in sorted(own.items()):
        terms, at = set(), 0
        for m in WORD.finditer(text, *words_in(text, k)):
            while at < len(spans) and spans[at][2] <= m.start():
                at += 1
            if not any(a < m.end() and m.start() < b for a, _, b in spans[at : at + 8]):
                terms.add(m[0].lower())
        out.append((k, sorted(entities), sorted(terms)))
    return out


def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans of each row, its number of contexts, and the contexts that hold a value."""
    item = pa.list_(pa.struct([("entities", pa.list_(pa.int64())), ("terms", pa.list_(pa.string()))]))
    for batch in text_blocks(batches, 2_000_000):
        cols: dict[str, list] = {k: [] for k in ("starts", "kinds", "ends", "contexts", "n")}
        for text in texts_of(batch):
            spans = base_spans(text)
            cols["starts"].append([s for s, _, _ in spans])
            cols["kinds"].append([k for _, k, _ in spans])
            cols["ends"].append([e for _, _, e in spans])
            cols["contexts"].append([{"entities": e, "terms": t} for _, e, t in contexts(text, spans)] if spans else [])
            cols["n"].append(max(1, -(-len(text) // CONTEXT)))
        yield pa.RecordBatch.from_pydict({
            **{c: batch.column(c) for c in ("doc_id", *KEYS)}, **{k: pa.array(cols[k], pa.list_(pa.int32())) for k in ("starts", "kinds", "ends")},
            "contexts": pa.array(cols["contexts"], item), "n_contexts": pa.array(cols["n"], pa.int32()),
        })


def base_table(docs: DataFrame) -> DataFrame:
    """doc_id, the text's keys, base spans as parallel arrays, and the contexts that hold a value; written out, as it is read several times."""
    rows = docs.select("doc_id", text_or_empty().alias("text"), *text_keys())
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, key_a long, key_b long, starts array<int>, kinds array<int>, ends array<int>, contexts array<struct<entities: array<long>, terms: array<string>>>, n_contexts int"
    return written(rows.mapInArrow(scanned, schema))


def buckets_for(n: int) -> int:
    """A power of two of at least eight buckets for each key, up to the bound."""
    return min(MOST_BUCKETS, 1 << max(16, (8 * n).bit_length()))


def size_table(counts: DataFrame, place: F.Column, most: bool, empty: int) -> np.ndarray:
    """One byte for each bucket: the largest ceil(log2 n) of its keys, or the smallest floor(log2 n), or `empty`."""
    size = buckets_for(counts.count())
    log = F.log2(F.col("n").cast("double"))
    value = (F.max(F.ceil(log)) if most else F.min(F.floor(log))).cast("byte")
    got = counts.groupBy(F.pmod(place, F.lit(size)).cast("int").alias("bucket")).agg(value.alias("value")).toArrow()
    out = np.full(size, empty, dtype=np.int8)
    out[np.asarray(got.column("bucket"))] = np.asarray(got.column("value"))
    return out


def met_pairs(held: DataFrame, with_entity: DataFrame, beside: DataFrame, slack: float) -> DataFrame:
    """entity, term, both: contexts that hold both, of pairs whose counts leave the ratio a chance."""
    context = held.sparkSession.sparkContext
    tables = context.broadcast((size_table(with_entity, F.col("entity"), True, -1), size_table(beside, F.crc32("term"), False, 127)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_entity, of_term = tables.value
        seen: Counter = Counter()

        def emitted() -> pa.RecordBatch:
            keys = list(seen)
            out = pa.RecordBatch.from_pydict({"entity": pa.array([k[0] for k in keys], pa.int64()), "term": pa.array([k[1] for k in keys], pa.string()), "n": pa.array(list(seen.values()), pa.int64())})
            seen.clear()
            return out

        for batch in batches:
            for entities, terms in zip(batch.column("entities").to_pylist(), batch.column("terms").to_pylist(), strict=True):
                live = [(e, v) for e in entities if (v := of_entity[e % len(of_entity)]) >= 0]
                if live:
                    low = of_term[np.fromiter((crc32(t.encode("utf-8", "surrogatepass")) for t in terms), dtype=np.int64, count=len(terms)) % len(of_term)]
                    for e, v in live:
                        seen.update((e, terms[k]) for k in np.flatnonzero(low <= v + slack))
                if len(seen) > 200_000:
                    yield emitted()
        yield emitted()

    return held.mapInArrow(run, "entity long, term string, n long").groupBy("entity", "term").agg(F.sum("n").alias("both"))


def bit_table(candidates: DataFrame) -> np.ndarray:
    """Bits set at the hashes of the candidate terms; the size follows their number, up to a fixed bound."""
    bits = buckets_for(candidates.count())
    places = candidates.select((F.pmod(F.crc32("term"), F.lit(bits)) / 8).cast("int").alias("byte"), F.pmod(F.crc32("term"), F.lit(8)).cast("int").alias("bit"))
    packed = places.distinct().groupBy("byte").agg(F.sum(F.pow(F.lit(2), F.col("bit"))).cast("int").alias("value")).toArrow()
    out = np.zeros(bits // 8, dtype=np.uint8)
    out[np.asarray(packed.column("byte"))] = np.asarray(packed.column("value")).astype(np.uint8)
    return out


class Passing:
    """Which words a table of candidate terms lets through; known words are remembered."""

    def __init__(self, table: bytes):
        self.table, self.known, self.any = table, {}, any(table)

    def __call__(self, word: str) -> bool:
        if (x := self.known.get(word)) is None:
            if len(self.known) > 200_000:
                self.known.clear()
            place = crc32(word.lower().encode("utf-8", "surrogatepass")) % (len(self.table) * 8)
            x = self.known[word] = bool(self.table[place >> 3] >> (place & 7) & 1)
        return x


def spread(docs: DataFrame, base: DataFrame, candidates: DataFrame) -> DataFrame:
    """term, with_term: in how many contexts of distinct texts each candidate stands.

    Tasks add up the texts of which there is one copy only; of others (their keys are known by a bit table) they emit
    each term once, and Spark makes those distinct.
    """
    context = docs.sparkSession.sparkContext
    several = base.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key_a")
    terms, copied = context.broadcast(bit_table(candidates).tobytes()), context.broadcast(bit_words(several, KEY_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes, sums, done = Passing(terms.value), Counter(), set()

        def emitted(rows: list[tuple]) -> pa.RecordBatch:
            a, b, term, n = zip(*rows, strict=True) if rows else ((), (), (), ())
            return pa.RecordBatch.from_pydict({"key_a": pa.array(a, pa.int64()), "key_b": pa.array(b, pa.int64()), "term": pa.array(term, pa.string()), "n": pa.array(n, pa.int64())})

        for batch in text_blocks(batches, 2_000_000) if passes.any else ():
            many = in_bits(copied.value, np.asarray(batch.column("key_a"), dtype=np.int64)).tolist()
            rows: list[tuple] = []
            for a, b, text, often in zip(batch.column("key_a").to_pylist(), batch.column("key_b").to_pylist(), texts_of(batch), many, strict=True):
                if often and (a, b) in done:
                    continue
                own: Counter = Counter()
                for k in range(max(1, -(-len(text) // CONTEXT))):
                    own.update({w.lower() for w in set(WORD.findall(text, *words_in(text, k))) if passes(w)})
                if often:
                    done.add((a, b))
                    rows += [(a, b, t, n) for t, n in own.items()]
                else:
                    sums.update(own)
            if len(done) > 100_000:
                done.clear()
            if len(sums) > 200_000:
                rows += [(None, None, t, n) for t, n in sums.items()]
                sums.clear()
            yield emitted(rows)
        yield emitted([(None, None, t, n) for t, n in sums.items()])

    found = docs.select(text_or_empty().alias("text"), *text_keys()).mapInArrow(run, "key_a long, key_b long, term string, n long")
    # sums of single texts add up; the copies of one text all say the same
    once = found.groupBy(*KEYS, "term").agg(F.sum("n").alias("all_"), F.max("n").alias("one_"))
    return once.groupBy("term").agg(F.sum(F.when(F.col("key_a").isNull(), F.col("all_")).otherwise(F.col("one_"))).alias("with_term"))


def disclosing(docs: DataFrame, base: DataFrame, generalise: float = 2 / 3, remove: float = 0.9, alpha: float = 0.05) -> DataFrame:
    """The disclosing pairs: entity, term, ratio, action."""
    once = base.filter(F.size("contexts") > 0).select(*KEYS, "contexts").dropDuplicates(list(KEYS))
    held = written(once.select(F.inline("contexts")))
    total = int(base.groupBy(*KEYS).agg(F.first("n_contexts").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    n = lambda df, c: df.groupBy(c).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    with_entity, beside = written(n(held.select(F.explode("entities").alias("entity")), "entity")), written(n(held.select(F.explode("terms").alias("term")), "term"))
    ic = F.log2(F.lit(max(2.0, float(total))) / F.least(F.col("with_entity"), F.lit(max(1.0, total / 2.0))))
    slack = (1 - generalise) * math.log2(max(2, total)) + 1
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    pairs = written(met_pairs(held, with_entity, beside, slack).filter("both > 1"))
    tests = pairs.groupBy("entity").agg(F.count(F.lit(1)).alias("tests"))
    sizes = with_entity.withColumnRenamed("n", "with_entity").join(tests, "entity").withColumn("need", F.log2(F.col("tests") / alpha)).withColumn("salt", salt)
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int"))
    met = written(salted.join(sizes.hint("merge"), ["entity", "salt"]).join(beside.withColumnRenamed("n", "beside"), "term").drop("salt", "tests").withColumn("ic", ic))
    ratio = lambda all_: 1 + F.log2(F.least(F.lit(1.0), F.col("both") / F.col(all_))) / F.col("ic")
    candidates = written(met.filter((ratio("beside") >= generalise) & (evidence("beside") >= F.col("need"))).drop("beside"))
    held_in = spread(docs, base, candidates.select("term").distinct())
    told = candidates.join(held_in, "term").filter((ratio("with_term") >= generalise) & (evidence("with_term") >= F.col("need")))
    told = told.select("entity", "term", ratio("with_term").alias("ratio"))
    return written(told.withColumn("action", F.when(F.col("ratio") >= remove, "remove").otherwise("generalise")))


def evidence(all_: str) -> F.Column:
    """n * KL(both / n || p(entity)) in bits, for the n contexts of the term; 0 where the entity is rarer with the term than without."""
    p = F.least(F.lit(1.0), F.col("both") / F.col(all_))
    q = F.pow(F.lit(2.0), -F.col("ic"))
    rest = F.when(p < 1, (1 - p) * F.log2((1 - p) / (1 - q))).otherwise(0.0)
    return F.when(p > q, F.col(all_) * (p * F.log2(p / q) + rest)).otherwise(0.0)


def wanted(told: DataFrame, base: DataFrame) -> DataFrame:
    """The text's keys, and its terms (term, action) that disclose an entity of the same text.

    Only terms that the table of told terms lets through leave their text. Told terms are salted, since one may stand in
    very many texts; Spark's estimate of the small table does not show its SALTS copies, so these are never broadcast.
    """
    table = told.sparkSession.sparkContext.broadcast(bit_table(told.select("term").distinct()).tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = Passing(table.value)
        for batch in batches if passes.any else ():
            rows = []
            for a, b, own in zip(*(batch.column(c).to_pylist() for c in (*KEYS, "contexts")), strict=True):
                entities = sorted({e for x in own for e in x["entities"]})
                rows += [(a, b, t, entities) for t in {t for x in own for t in x["terms"] if passes(t)}]
            a, b, term, entities = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_pydict({"key_a": pa.array(a, pa.int64()), "key_b": pa.array(b, pa.int64()), "term": pa.array(term, pa.string()), "entities": pa.array(entities, pa.list_(pa.int64()))})

    once = base.filter(F.size("contexts") > 0).select(*KEYS, "contexts").mapInArrow(run, "key_a long, key_b long, term string, entities array<long>").dropDuplicates([*KEYS, "term"])
    salted = told.select("entity", "term", "action", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")).hint("merge")
    met = once.withColumn("salt", F.pmod("key_a", F.lit(SALTS)).cast("int")).join(salted, ["term", "salt"]).filter(F.array_contains("entities", F.col("entity")))
    hits = met.groupBy(*KEYS, "term").agg(F.max("action").alias("action"))  # remove goes before generalise
    return hits.groupBy(*KEYS).agg(F.collect_list(F.struct("term", "action")).alias("told"))


def term_spans(docs: DataFrame, told: DataFrame, base: DataFrame) -> DataFrame:
    """The text's keys and its added spans as an array of (start, kind, end, action). Only texts with such terms move."""
    terms = written(wanted(told, base))
    shared = docs.sparkSession.sparkContext.broadcast(bit_words(terms.select("key_a"), KEY_BITS))

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bits(shared.value, np.asarray(batch.column("key_a"), dtype=np.int64))))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("action", pa.string())]))
        for batch in text_blocks(batches):
            out = []
            for text, own in zip(texts_of(batch), batch.column("told").to_pylist(), strict=True):
                action = {x["term"]: x["action"] for x in own}
                out.append([{"start": m.start(), "kind": 4, "end": m.end(), "action": a} for m in WORD.finditer(text) if (a := action.get(m[0].lower()))])
            yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in KEYS}, "added": pa.array(out, item)})

    texts = docs.select(text_or_empty().alias("text"), *text_keys())
    rows = texts.mapInArrow(moved, texts.schema).dropDuplicates(list(KEYS)).join(terms, list(KEYS))
    return rows.mapInArrow(places, "key_a long, key_b long, added array<struct<start: int, kind: int, end: int, action: string>>")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, the text's keys, base and spans: arrays of (start, kind, end, action), sorted by start, then kind."""
    base = base_table(docs)
    added = term_spans(docs, disclosing(docs, base), base)
    zipped = F.transform(F.arrays_zip("starts", "kinds", "ends"), lambda x: F.struct(x["starts"].alias("start"), x["kinds"].alias("kind"), x["ends"].alias("end"), F.lit("mask").alias("action")))
    rows = base.select("doc_id", *KEYS, zipped.alias("base")).join(added, list(KEYS), "left")
    free = F.filter(F.coalesce("added", F.array().cast(added.schema["added"].dataType)), lambda x: ~F.exists("base", lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])))
    return rows.select("doc_id", *KEYS, "base", F.array_sort(F.concat("base", free)).alias("spans"))


def shown(spans: str) -> F.Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), x["kind"] + 1), x["start"], x["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts of base spans, a digest of them, and all spans, one row per document."""
    rows = scan(docs)
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return rows.select("doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(4)], F.sha2(shown("base"), 256).alias("base_sha256"), shown("spans").alias("spans"))


def shape(word: str) -> str:
    """What is left of a generalised term: its length, and its first letter if it has four or more."""
    return f"{word[0]}{'*' * (len(word) - 1)}" if len(word) > 3 else "*" * len(word)


def masked(text: str, spans: list[dict]) -> str:
    """The text with base spans as <kind>, generalised terms as shapes, and removed terms taken out."""
    out, done = [], 0
    for s in spans:
        if s["start"] < done:  # inside an earlier span
            if s["end"] > done and s["action"] == "mask":
                done = s["end"]
            continue
        out.append(text[done : s["start"]])
        out.append(f"<{KINDS[s['kind']]}>" if s["action"] == "mask" else shape(text[s["start"] : s["end"]]) if s["action"] == "generalise" else "")
        done = s["end"]
    return "".join(out) + text[done:]


def sanitised(docs: DataFrame) -> DataFrame:
    """docs with all its columns, whatever their names; the text masked by the spans of scan(); a column n_chars follows the new text."""
    spans = scan(docs).filter(F.size("spans") > 0).select(*KEYS, "spans").dropDuplicates(list(KEYS))
    schema = docs.schema
    keyed = docs.select(F.struct("*").alias("row"), *text_keys())
    joined = keyed.join(spans, list(KEYS), "left").select("row", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_blocks(batches, texts=lambda b: pc.struct_field(b.column("row"), "text")):
            out = dict(zip(schema.names, batch.column("row").flatten(), strict=True))
            texts = [t if t is None or not s else masked(t, s) for t, s in zip(out["text"].to_pylist(), batch.column("spans").to_pylist(), strict=True)]
            if "n_chars" in out:
                out["n_chars"] = pa.array([None if t is None else len(t) for t in texts], out["n_chars"].type)
            yield pa.RecordBatch.from_pydict(out | {"text": pa.array(texts, pa.string())})

    return joined.mapInArrow(run, schema)
