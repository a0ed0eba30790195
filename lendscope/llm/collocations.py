"""Phrase collocations by best-first branch-and-bound growth.

For a phrase of 2 to `longest` words with f(phrase) = a >= `least`, a cut after k words gives
floor(1000 * a * n / (l * r)), l = f(first k words), r = f(rest), n = words of the language;
the lowest cut is its score. As a <= l and a <= r, no cut of a phrase scores above
floor(1000 * n / l), whatever follows the prefix, nor above floor(1000 * n / r): counts of
prefixes (and of suffixes) bound all phrases that grow from them.

Best first. The words of a language with the rarest, i.e. the best bounds, make the frontier:
those of count <= limit. Everything that starts or ends with one of them is grown level by
level; what does neither scores at most floor(1000 * n / (limit + 1)). Phrases above that
are complete, and so are their parts at every cut (a prefix starts as the phrase does, a
suffix ends as it does) and all their extensions by one word. A language is settled if
`top` phrases that are not dropped score above that bound, which also settles ties;
otherwise its frontier grows to the next share of its word occurrences, in the end to all.

Growth over chunks of documents, with exact counts:

1. A chunk numbers its words once. Per level it sends each distinct phrase that it could
   hold, with its count, to a bucket by hash; a phrase is the node of its prefix and its last
   word (or, where only the last word is in the frontier, its first word and the node of its
   suffix). Nodes are numbers of whole phrases, so keys are exact, not hashed.
2. A bucket adds up, numbers the phrases of `least` and more, and answers the chunks. Its
   smallest chunk owns a phrase. The most frequent phrase is one entry per chunk.
3. In the end the owner scores a phrase by the counts that it has got, drops it if the
   extension at its first place is as frequent (were all occurrences inside one longer
   phrase, so is this one), and returns its best `top` of each language.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, only, ship_package, stored, table, text_or_empty
from .packed import pack, pack_sorted, pack_words, unpack, unpack_sorted, unpack_words
from .wordcodes import mixed

BREAK, NONE = 0, -1
SLICE = 1 << 20                                       # bytes of a text that are split together
SALTS = 16
_AS_SPLIT = bytes(10 if c in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if c == 9 else c for c in range(256))

ASK = "bucket long, chunk long, places binary, keys binary, counts binary"
ANSWER = "chunk long, level int, places binary, nodes binary, counts binary, owned binary"
LIMITS = "lang string, n long, most long, floor long"
FOUND = "lang string, phrase string, a long, l long, r long, n long, score long"


# -- chunks ----------------------------------------------------------------

class _Numbers(dict):
    """Numbers the words of one language in a chunk, from 1, in order of their first place."""

    def __init__(self, lang: int, words: list[bytes], lang_of: list[int]):
        super().__init__({b"": NONE, b"\n": BREAK})
        self.lang, self.words, self.lang_of = lang, words, lang_of

    def __missing__(self, word: bytes) -> int:
        self.words.append(word)
        self.lang_of.append(self.lang)
        self[word] = n = len(self.words)
        return n


def _slices(raw: bytes) -> Iterator[tuple[bytes, bool]]:
    """(part, whether it ends at the end of a piece); cut between words only."""
    at = 0
    while len(raw) - at > 2 * SLICE:
        cut = raw.find(b"\n", at + SLICE, at + 2 * SLICE)
        if cut < 0:
            found = re.compile(rb"[ \n]").search(raw, at + SLICE)
            if not found:
                break
            cut = found.start()
        yield raw[at:cut], raw[cut] == 10
        at = cut
    yield raw[at:], True


def chunks_of(docs: DataFrame, chunk_bytes: int, text_col: str, lang_col: str) -> DataFrame:
    """(chunk, langs, sizes, lang_of, words, numbers): a row per chunk. `numbers` are the word
    numbers in order, BREAK between pieces; a chunk ends with a piece."""
    src = only(docs, text_col, lang_col).select(text_or_empty(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, size = TaskContext.get().partitionId(), 0, 0
        words: list[bytes] = []
        lang_of: list[int] = []
        numbers: list[np.ndarray] = []
        known: dict[str, _Numbers] = {}
        counts: dict[str, int] = {}

        def row() -> pa.RecordBatch:
            nonlocal made, size
            flat = np.concatenate(numbers)
            flat = flat[(flat != BREAK) | np.append(True, flat[:-1] != BREAK)]
            out = pa.RecordBatch.from_arrays([
                pa.array([(task << 32) + made]), pa.array([list(known)], pa.list_(pa.string())),
                pa.array([[counts[x] for x in known]], pa.list_(pa.int64())), pa.array([pack(np.array(lang_of, "<i4"))]),
                pa.array([pack_words(words)]), pa.array([pack(flat, level=3)])],
                ["chunk", "langs", "sizes", "lang_of", "words", "numbers"])
            words.clear(), lang_of.clear(), numbers.clear(), known.clear(), counts.clear()
            made, size = made + 1, 0
            return out

        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                raw, lang = text.as_buffer().to_pybytes().lower().translate(_AS_SPLIT), lang.as_py()
                for part, ends in _slices(raw):
                    if lang not in known:
                        known[lang], counts[lang] = _Numbers(len(known), words, lang_of), 0
                    split = part.replace(b"\n", b" \n ").split(b" ")
                    of = np.fromiter(map(known[lang].__getitem__, split), "<i4", len(split))
                    of = of[of != NONE]
                    counts[lang] += int((of != BREAK).sum())
                    numbers.append(of)
                    size += len(part) + 1
                    if ends:
                        numbers.append(np.zeros(1, "<i4"))
                        if size >= chunk_bytes:
                            yield row()
        if numbers:
            yield row()

    return map_batches(src, gather, "chunk long, langs array<string>, sizes array<long>, lang_of binary, words binary, numbers binary")


def _distinct(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place of each distinct code, number of its code for each place, counts), by
    ascending code. Code and place are sorted as one number where they fit."""
    n = len(code)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    least, bits = int(code.min()), n.bit_length()
    if (int(code.max()) - least).bit_length() + bits < 64:
        both = ((code - least) << bits) | np.arange(n)
        both.sort()
        order, ascending = both & ((1 << bits) - 1), both >> bits
    else:
        order = np.argsort(code, kind="stable")
        ascending = code[order]
    begins = np.append(True, ascending[1:] != ascending[:-1])
    number = np.empty(n, np.int64)
    number[order] = np.cumsum(begins) - 1
    return order[begins], number, np.diff(np.append(np.flatnonzero(begins), n))


class Chunk:
    """The words of a chunk, and per level which phrase begins at a place and its count."""

    def __init__(self, row: dict):
        self.number, self.langs, self.packed_words = row["chunk"], row["langs"], row.get("words")
        self.lang_of = unpack(row["lang_of"], "<i4")
        self.at = unpack(row["numbers"], "<i4").astype(np.int64) - 1           # NONE at breaks

    @functools.cached_property
    def words(self) -> list[bytes]:
        return unpack_words(self.packed_words)

    def place(self, answers: pa.Table, limits: pa.Table, levels: int) -> None:
        """Tables of levels 1 to `levels` from what the buckets answered."""
        most = np.zeros(len(self.langs), np.int64)
        self.n, self.floor = [0] * len(self.langs), [0] * len(self.langs)
        number = {lang: i for i, lang in enumerate(self.langs)}
        for row in limits.select(["lang", "n", "most", "floor"]).to_pylist():
            i = number[row["lang"]]
            most[i], self.n[i], self.floor[i] = row["most"], row["n"], row["floor"]
        self.cur, self.node, self.count, self.owned, self.first, self.held = [self.at], [None], [None], [None], [None], [None]
        of_level = {}
        for row in answers.to_pylist():
            of_level.setdefault(row["level"], []).append(row)
        kept = self._take(len(self.lang_of), of_level.get(1, []))
        self.cur.append(kept[self.at])
        self.frequent = self.cur[1] >= 0                                       # whether a word of `least` stands there
        count = self.count[1]
        self.frontier = (count > 0) & (count <= most[self.lang_of])
        self.held.append(np.flatnonzero(np.append(self.frontier, False)[self.cur[1]]))
        for level in range(2, levels + 1):
            taken, inverse, place, _, _ = self._grown(level)
            kept = self._take(len(place), of_level.get(level, []))[inverse]
            cur = np.full(len(self.at), NONE, np.int64)
            cur[taken] = kept
            self.cur.append(cur)
            self.held.append(taken[kept >= 0])
            self.first.append(place)

    def _take(self, size: int, rows: list[dict]) -> np.ndarray:
        """The number of each of `size` phrases, NONE for those that no answer holds; last, NONE for NONE."""
        node, count, owned = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, bool)
        for row in rows:
            at = unpack_sorted(row["places"]).astype(np.int64)
            node[at], count[at], owned[at] = unpack(row["nodes"], "<i8"), unpack(row["counts"], "<i8"), unpack(row["owned"], "?")
        self.node.append(node)
        self.count.append(count)
        self.owned.append(owned)
        return np.append(np.where(count > 0, np.arange(size), NONE), NONE)

    def _grown(self, level: int) -> tuple[np.ndarray, ...]:
        """(places, number of the phrase at each, and per phrase: first place, whether it is a
        prefix with a word behind, count) of the distinct phrases of `level` words that could
        reach `least` and start or end in the frontier. Only places next to what the level
        before holds are looked at (level 2: next to a frontier word)."""
        n = max(len(self.at) - level + 1, 0)
        near = np.zeros(len(self.at) + 1, bool)
        near[self.held[level - 1]] = True
        near[self.held[level - 1] - 1] = True                                  # place -1 is the spare last one
        words, parts = self.cur[1], self.cur[level - 1]
        at = np.flatnonzero(near[:n] & self.frequent[:n] & self.frequent[level - 1:level - 1 + n])
        first, last, prefix, suffix = words[at], words[at + level - 1], parts[at], parts[at + 1]
        known = np.append(self.frontier, False)                                # NONE is no frontier word
        starts, ends = known[first], known[last]
        forward = starts & (prefix >= 0) & (~ends | (suffix >= 0))
        backward = ~starts & ends & (suffix >= 0)
        wide, tall = len(self.lang_of), max(len(self.node[level - 1]), 1)
        taken = forward | backward
        onward = forward[taken]
        code = np.where(onward, prefix[taken] * wide + last[taken], -(first[taken] * tall + suffix[taken]) - 1)
        begin, inverse, counts = _distinct(code)
        at = at[taken]
        return at, inverse, at[begin], onward[begin], counts

    def keys(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(parts, counts) of the phrases that `_grown` numbers. Parts: two nodes, the second
        marked where it is a suffix."""
        _, _, place, onward, counts = self._grown(level)
        words, parts = self.cur[1], self.cur[level - 1]
        left, right = self.node[level - 1], self.node[1]
        keys = np.empty((len(place), 2), np.int64)
        keys[:, 0] = np.where(onward, left[parts[place]], right[words[place]])
        keys[:, 1] = np.where(onward, right[words[place + level - 1]], left[parts[place + 1]] | np.int64(-(2**63)))
        return keys, counts

    def best(self, top: int) -> dict[str, list]:
        """The best `top` owned phrases of each language that are not dropped, and score at least its floor."""
        rows: dict[int, list] = {}
        longest = len(self.cur) - 1
        for level in range(2, longest + 1):
            owned = np.flatnonzero(self.owned[level])
            place = self.first[level - 1][owned]
            ends = self.cur[1][place + level - 1]
            both = self.frontier[self.cur[1][place]] & self.frontier[ends]
            owned, place = owned[both], place[both]
            a = self.count[level][owned]
            if level < longest:
                gone = np.zeros(len(place), bool)
                for shift in (0, 1):                                            # the extension to the right, to the left
                    at = self.cur[level + 1][np.maximum(place - shift, 0)]
                    gone |= (at >= 0) & (place >= shift) & (np.append(self.count[level + 1], 0)[at] == a)
                place, a = place[~gone], a[~gone]
            left = [self.count[k][self.cur[k][place]].tolist() for k in range(1, level)]
            right = [self.count[level - k][self.cur[level - k][place + k]].tolist() for k in range(1, level)]
            for i, (p, count) in enumerate(zip(place.tolist(), a.tolist(), strict=True)):
                lang = int(self.lang_of[self.at[p]])
                over = 1000 * count * self.n[lang]                              # Python integers: exact
                score, k = min((over // (left[k][i] * right[k][i]), k) for k in range(level - 1))
                if score >= self.floor[lang]:
                    phrase = b" ".join([self.words[x] for x in self.at[p:p + level].tolist()])
                    rows.setdefault(lang, []).append((-score, -count, phrase, left[k][i], right[k][i]))
        out: dict[str, list] = {c: [] for c in ("lang", "phrase", "a", "l", "r", "n", "score")}
        for lang, found in rows.items():
            for score, count, phrase, l, r in sorted(found)[:top]:
                for name, value in zip(out, (self.langs[lang], phrase.decode(), -count, l, r, self.n[lang], -score), strict=True):
                    out[name].append(value)
        return out


# -- counting --------------------------------------------------------------

def _dealt(chunk: int, of: np.ndarray, buckets: int, counts: np.ndarray, packed) -> pa.Table:
    """A row per bucket that a chunk has keys for; `packed(places)` gives their bytes."""
    order = np.argsort(of, kind="stable")
    bounds = np.searchsorted(of[order], np.arange(buckets + 1))
    out: dict[str, list] = {c: [] for c in ("bucket", "chunk", "places", "keys", "counts")}
    for b in np.flatnonzero(np.diff(bounds)).tolist():
        mine = order[bounds[b]:bounds[b + 1]]
        for name, value in zip(out, (b, chunk, pack_sorted(mine), packed(mine), pack(counts[mine].astype("<i8"))), strict=True):
            out[name].append(value)
    return pa.table(out, schema=pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), *[(c, pa.binary()) for c in ("places", "keys", "counts")]]))


def word_asks(chunks: DataFrame, buckets: int) -> DataFrame:
    """Each distinct word of a chunk as language, space, word (a word holds no space)."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row)
                langs = [lang.encode() for lang in chunk.langs]
                keys = [langs[i] + b" " + word for i, word in zip(chunk.lang_of.tolist(), chunk.words, strict=True)]
                of = np.fromiter((zlib.crc32(k) % buckets for k in keys), np.int64, len(keys))
                counts = np.bincount(chunk.at[chunk.at >= 0], minlength=len(keys))
                yield from _dealt(chunk.number, of, buckets, counts, lambda at, keys=keys: pack_words([keys[i] for i in at])).to_batches()

    return map_batches(chunks, ask, ASK)


def _answered(rows: pa.Table, key: np.ndarray, least: int, level: int) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """Answers to the asking chunks for keys numbered 0, 1, ... (`key`, in order of the rows and
    their places); total counts; the node number of each key."""
    places = [unpack_sorted(x) for x in rows["places"].to_pylist()]
    counts = np.concatenate([unpack(x, "<i8") for x in rows["counts"].to_pylist()])
    bounds = np.cumsum([0, *map(len, places)])
    total = np.zeros(int(key.max(initial=-1)) + 1, np.int64)
    np.add.at(total, key, counts)
    frequent = total >= least
    node = (rows["bucket"][0].as_py() << 32) + np.cumsum(frequent)
    _, first = np.unique(key, return_index=True)
    owner = np.zeros(len(key), bool)
    owner[first] = True
    out: dict[str, list] = {c: [] for c in ("chunk", "level", "places", "nodes", "counts", "owned")}
    for chunk, place, a, b in zip(rows["chunk"].to_pylist(), places, bounds[:-1], bounds[1:], strict=True):
        kept = frequent[key[a:b]]
        if kept.any():
            mine = key[a:b][kept]
            for name, value in zip(out, (chunk, level, pack_sorted(place[kept]), pack(node[mine]), pack(total[mine]),
                                         pack(owner[a:b][kept])), strict=True):
                out[name].append(value)
    kinds = [("chunk", pa.int64()), ("level", pa.int32()), *[(c, pa.binary()) for c in ("places", "nodes", "counts", "owned")]]
    return pa.table(out, schema=pa.schema(kinds)), total, node


def word_answers(asks: DataFrame, least: int) -> DataFrame:
    """ANSWER rows of level 1, and in `mass` (of one row per bucket) the occurrences of the
    frequent words by language and power of two of their count."""
    def count(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")
        known: dict[bytes, int] = {}
        key = np.array([known.setdefault(w, len(known)) for packed in rows["keys"].to_pylist() for w in unpack_words(packed)], np.int64)
        out, total, _ = _answered(rows, key, least, 1)
        mass: dict[tuple[str, int], int] = {}
        for word, n in zip(known, total.tolist(), strict=True):
            if n >= least:
                at = (word.rpartition(b" ")[0].decode(), n.bit_length())
                mass[at] = mass.get(at, 0) + n
        held = [[{"lang": x, "bits": bits, "n": n} for (x, bits), n in mass.items()], *[None] * max(out.num_rows - 1, 0)][:out.num_rows]
        return out.append_column("mass", pa.array(held, pa.list_(pa.struct([("lang", pa.string()), ("bits", pa.int32()), ("n", pa.int64())]))))

    return asks.groupBy("bucket").applyInArrow(count, ANSWER + ", mass array<struct<lang string, bits int, n long>>")


def phrase_answers(asks: DataFrame, least: int, level: int) -> DataFrame:
    def count(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")
        parts = np.concatenate([unpack(x, "<i8").reshape(2, -1).T for x in rows["keys"].to_pylist()])
        order = np.lexsort((parts[:, 1], parts[:, 0]))
        new = np.append(True, (parts[order[1:]] != parts[order[:-1]]).any(axis=1))
        key = np.empty(len(parts), np.int64)
        key[order] = np.cumsum(new) - 1
        return _answered(rows, key, least, level)[0]

    return asks.groupBy("bucket").applyInArrow(count, ANSWER)


# -- the search ------------------------------------------------------------

def _limits(sizes: DataFrame, mass: DataFrame, open_langs: DataFrame | None, share: float) -> DataFrame:
    """(lang, n, most, floor) of the languages still open: the frontier are words of at most
    `most` occurrences, about `share` of the frequent words' occurrences; phrases that score
    `floor` or more are complete with it."""
    by_bits = Window.partitionBy("lang").orderBy("bits").rowsBetween(Window.unboundedPreceding, 0)
    all_bits = Window.partitionBy("lang")
    within = (mass.withColumn("sum", F.sum("n").over(by_bits)).withColumn("all", F.sum("n").over(all_bits))
              .withColumn("least", F.min("bits").over(all_bits)).withColumn("top", F.max("bits").over(all_bits))
              .filter((F.col("sum") <= share * F.col("all")) | (F.col("bits") == F.col("least")))
              .groupBy("lang").agg(F.max("bits").alias("bits"), F.max("top").alias("top")))
    most = F.expr("shiftleft(1L, bits) - 1")
    out = sizes.join(within, "lang").select(
        "lang", F.col("size").alias("n"), most.alias("most"),
        F.when(F.col("bits") == F.col("top"), F.lit(0)).otherwise(F.expr("1000 * size div shiftleft(1L, bits) + 1")).cast("long").alias("floor"))
    return out if open_langs is None else out.join(open_langs, "lang", "left_semi")


def collocations(docs: DataFrame, top: int = 2000, least: int = 100, longest: int = 5, shares: tuple[float, ...] = (1 / 16, 1 / 4, 1.0),
                 text_col: str = "text", lang_col: str = "lang", chunk_bytes: int | None = None, bucket_bytes: int | None = None) -> DataFrame:
    """Per language (null: `und`) the `top` phrases by score, then a, then phrase: lang, rank,
    phrase, a, l, r, n, score.

    A null text counts as empty. Repeated rows count as often as they stand there. Languages
    without a candidate have no rows; an empty table gives an empty result. A phrase inside a
    longer one that is as frequent is dropped. `shares` (ending in 1) are the parts of a
    language's frequent word occurrences that the frontier covers from wave to wave.

    A task holds a chunk of about `chunk_bytes` of text (longer where a piece without
    punctuation is) or the keys of one bucket. Both sizes default to the larger of 8 MB and
    the root of 640 times the bytes of the input, so that a chunk's row for a bucket keeps some
    64 keys at any size. `docs` should be a stored table; chunks are stored once.
    """
    if not shares or shares[-1] != 1 or least < 1:
        raise ValueError("shares must end in 1, least be at least 1")
    spark = docs.sparkSession
    ship_package(spark)
    total = docs.agg(F.sum(F.octet_length(text_or_empty(text_col)))).first()[0] or 0
    even = max(1 << 23, math.isqrt(640 * total))
    buckets = max(1, -(-total // (bucket_bytes or even)))
    chunks = stored(chunks_of(docs, chunk_bytes or even, text_col, lang_col), "phrase-chunks")
    in_langs = F.explode(F.arrays_zip("langs", "sizes")).alias("of")
    sizes = (chunks.select(in_langs).select(F.col("of.langs").alias("lang"), F.col("of.sizes").alias("size"))
             .groupBy("lang").agg(F.sum("size").alias("size")))
    words = stored(word_answers(word_asks(chunks, buckets), least), "phrase-words")
    mass = (words.select(F.explode("mass").alias("of")).select("of.*").groupBy("lang", "bits").agg(F.sum("n").alias("n")))

    open_langs, results = None, []
    for share in shares:
        limits = stored(_limits(sizes, mass, open_langs, share), "phrase-limits")
        found = stored(_wave(chunks, words.drop("mass"), limits, buckets, top, least, longest), "phrase-found")
        per_lang = found.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
        judged = limits.join(per_lang, "lang", "left").select("lang", ((F.col("floor") == 0) | (F.coalesce("rows", F.lit(0)) >= top)).alias("settled"))
        judged = stored(judged, "phrase-judged")
        results.append(found.join(judged.filter("settled").select("lang"), "lang", "left_semi"))
        open_langs = judged.filter("not settled").select("lang")
        if open_langs.isEmpty():
            break
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    # The best of each share of a language first, so that no task ranks what all chunks return.
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = out.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _wave(chunks: DataFrame, words: DataFrame, limits: DataFrame, buckets: int, top: int, least: int, longest: int) -> DataFrame:
    """Grow the frontier of `limits` level by level; the chunks' best phrases (FOUND)."""
    salt = F.pmod(F.xxhash64("chunk"), F.lit(SALTS))
    copies = limits.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    own_limits = (chunks.select("chunk", F.explode("langs").alias("lang"), salt.alias("salt")).join(copies, ["lang", "salt"])
                  .select("chunk", F.lit(0).alias("level"), "lang", "n", "most", "floor"))
    known = words.unionByName(own_limits, allowMissingColumns=True)

    def chunk_of(rows: pa.Table, answers: pa.Table, levels: int) -> Chunk | None:
        if not rows.num_rows:
            return None
        chunk = Chunk(rows.to_pylist()[0])
        zero = pa.compute.equal(answers["level"], 0)
        chunk.place(answers.filter(pa.compute.invert(zero)).drop_columns(["lang", "n", "most", "floor"]), answers.filter(zero), levels)
        return chunk

    def asks_of(level: int):
        def ask(key, rows: pa.Table, answers: pa.Table) -> pa.Table:
            chunk = chunk_of(rows, answers, level - 1)
            if chunk is None:
                return _dealt(0, np.zeros(0, np.int64), buckets, np.zeros(0, np.int64), None)
            keys, counts = chunk.keys(level)
            of = (mixed(mixed(keys[:, 0].view(np.uint64)) + keys[:, 1].view(np.uint64), 1) % np.uint64(buckets)).astype(np.int64) if len(keys) else np.zeros(0, np.int64)
            return _dealt(chunk.number, of, buckets, counts, lambda at: pack(np.ascontiguousarray(keys[at].T).ravel()))
        return ask

    def finish(key, rows: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = chunk_of(rows, answers, longest)
        kinds = [("lang", pa.string()), ("phrase", pa.string()), *[(c, pa.int64()) for c in ("a", "l", "r", "n", "score")]]
        return pa.table(chunk.best(top) if chunk else {c: [] for c, _ in kinds}, schema=pa.schema(kinds))

    numbers = chunks.drop("words")                    # the words themselves are needed in the end only

    def beside(rows: DataFrame, task, schema: str) -> DataFrame:
        return rows.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(task, schema)

    for level in range(2, longest + 1):
        answers = stored(phrase_answers(beside(numbers, asks_of(level), ASK), least, level), "phrase-answers")
        known = known.unionByName(answers, allowMissingColumns=True)
    return beside(chunks, finish, FOUND)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
s AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m),
f AS MATERIALIZED (SELECT lang, w[i:i + m - 1] AS g, m, count(*) AS f FROM s GROUP BY 1, 2, 3 HAVING count(*) >= 100),
inside AS (SELECT DISTINCT lang, g[i:i + k - 1] AS g, f FROM (
  SELECT lang, g, f, k, unnest(range(1, m - k + 2)) AS i FROM f, (SELECT unnest(range(2, 5)) AS k) WHERE k < m)),
cut AS (SELECT c.lang, c.g, c.f AS a, k, l.f AS l, r.f AS r, n.n,
          (CAST(1000 AS HUGEINT) * c.f * n.n) // (CAST(l.f AS HUGEINT) * r.f) AS score
        FROM (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m >= 2) c JOIN n ON n.lang = c.lang
        JOIN f l ON l.lang = c.lang AND l.g = c.g[1:k] JOIN f r ON r.lang = c.lang AND r.g = c.g[k + 1:]),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
kept AS (SELECT low.* FROM low ANTI JOIN inside ON inside.lang = low.lang AND inside.g = low.g AND inside.f >= low.a),
ranked AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM kept)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked QUALIFY rank <= 2000
"""

QUERIES = {"op11_collocations": (op11_collocations, OP11_SQL)}
