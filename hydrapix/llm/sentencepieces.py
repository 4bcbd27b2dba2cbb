"""SentencePiece encoding and decoding by a relational lattice.

Texts are written the way the model writes them (a space before the text, spaces as U+2581) and cut where no
piece of the table can reach across, so each word is segmented on its own and only distinct words need a lattice:
their places are exploded, the substrings that end at a place are equi-joined to the pieces that can be on a best way (fixed
size; those of more than three characters are found by their last four), and the places are grouped by word and folded by
Viterbi with Spark's higher-order aggregate. The segmentation has the largest sum of piece scores
(ties: the shorter last piece). Characters without a piece become their UTF-8 byte pieces.

A word of more than 256 characters (a run of letters without a space) goes in chunks of 128: a chunk has one lattice for
each place in it where the last piece of the chunk before can end, and each lattice gives the best way to each place
in the next chunk; these scores are folded from chunk to chunk. That is exact, linear in the word's length, and no
group holds more than a chunk's edges (ties at a chunk's border: the way that reaches it first).

Documents then take their words' ids: the `hot` most frequent words by a broadcast dictionary of bounded size,
all others by a shuffled join on the word, and these ids come back to their document as one row under its id.
Texts are cut and looked up a block at a time by word hashes; words whose hashes collide are told apart. Decoding turns
ids back into the text; the result says whether that gave the same text.

Cases: null and empty texts have no tokens and decode to the empty text; a text that holds U+2581 itself cannot
round trip, as in the model; invalid input cannot occur in a string column; repeated rows are returned each (their
words are looked up once for each task that has some of them); a null doc_id is a value like others; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import columns_of, dropped, mixed, pieces, written

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
SHORT = 3


def useful(rows: list[tuple[str, int, float]]) -> list[tuple[str, int, float]]:
    """Rows (piece, id, score) without the pieces whose own text other pieces spell with a larger sum of scores: a way through
    such a piece is beaten by the same way with these in its place, so no best way has it. Ties keep the piece. Scores that
    are whole numbers add up exactly; of others all pieces are kept."""
    score = {p: s for p, _, s in rows}
    if not all(s.is_integer() for s in score.values()):
        return rows
    longest = max(map(len, score))

    def best_of_parts(p: str) -> float:
        best = [0.0]
        for e in range(1, len(p) + 1):
            ways = (best[b] + score.get(p[b:e], -math.inf) for b in range(max(0, e - longest), e) if e - b < len(p))
            best.append(max(ways, default=-math.inf))
        return best[-1]

    return [r for r in rows if best_of_parts(r[0]) <= r[2]]


class Pieces:
    """The piece table of a model file: normal pieces with ids and scores, byte pieces, and where words may be cut."""

    def __init__(self, model_file: str = MODEL):
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(sp.get_piece_size())
        plain = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.rows = [(sp.id_to_piece(i), i, float(sp.get_score(i))) for i in plain]
        self.bytes_at = {int(sp.id_to_piece(i)[3:5], 16): i for i in ids if sp.is_byte(i)}
        self.useful = useful(self.rows)
        self.longest = max(len(p) for p, _, _ in self.useful)
        self.unknown_score = min(s for _, _, s in self.rows) - 10.0
        self.pairs = frozenset(p[i : i + 2] for p, _, _ in self.rows for i in range(len(p) - 1))
        assert not any(re.search(f"[^{SPACE}]{SPACE}|\n.|.\n", p) for p, _, _ in self.rows), "a piece spans words"
        self.surface = {i: p.replace(SPACE, " ").encode() for p, i, _ in self.rows} | {i: bytes([b]) for b, i in self.bytes_at.items()}

    def ends(self, spark: SparkSession) -> list[DataFrame]:
        """The pieces that can be on a best way by the characters they end with: tables k = 1 to SHORT (end<k>, id<k>, s<k>)
        of the pieces of k characters, then the longer ones (end<SHORT + 1>, longer) listed by their last characters."""
        out, rows = [], sorted((len(p), p, f"{i},", x) for p, i, x in self.useful)
        for k in range(1, SHORT + 1):
            out.append(spark.createDataFrame([r[1:] for r in rows if r[0] == k], f"end{k} string, id{k} string, s{k} double"))
        longer: dict[str, list] = {}
        for r in rows:
            if r[0] > SHORT:
                longer.setdefault(r[1][-SHORT - 1 :], []).append(r)
        return [*out, spark.createDataFrame(list(longer.items()), f"end{SHORT + 1} string, longer array<struct<l int, piece string, id string, s double>>")]

    def expand(self, ids: list[int]) -> list[int]:
        """-1 - c stands for the character c without a piece: its bytes."""
        out: list[int] = []
        for i in ids:
            out += [i] if i >= 0 else [self.bytes_at[b] for b in chr(-1 - i).encode()]
        return out


class Cutter:
    """Cuts many texts at once into words: between all adjacent characters that no piece holds together. A word
    has a 64-bit hash (by place and character) and a check (by character only); the two together tell words apart."""

    def __init__(self, pairs: frozenset):
        chars = sorted({ord(c) for p in pairs for c in p})
        self.kind, self.width = np.zeros(0x110000, np.int32), len(chars) + 1
        self.kind[chars] = np.arange(1, self.width)
        self.together = np.zeros(self.width * self.width, bool)
        self.together[[self.kind[ord(p[0])] * self.width + self.kind[ord(p[1])] for p in pairs]] = True
        self.value, self.power = mixed(np.arange(1, 0x110001, dtype=np.uint64)), np.ones(1, np.uint64)

    def hashes(self, chars: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(start):
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        longest = int(size.max())
        if longest > len(self.power):
            factors = np.full(2 * longest, 0xD6E8FEB86659FD93, np.uint64)
            factors[0] = 1
            self.power = np.cumprod(factors)
        value = self.value[chars]
        check = np.add.reduceat(value, start)
        value *= self.power[np.arange(len(chars)) - np.repeat(start, size)]
        return mixed(np.add.reduceat(value, start) + size.astype(np.uint64)), check

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and checks of words that stand alone (none empty)."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        return self.hashes(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), np.cumsum(size) - size, size)

    def __call__(self, texts: list[str | None]) -> tuple:
        """The texts as the model sees them in one string, starts and sizes of the words there, their hashes and
        checks, and the number of words of each text."""
        seen = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        whole = "".join(seen)
        chars = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(np.fromiter(map(len, seen), np.int64, len(seen)))
        kind = self.kind[chars]
        first = np.ones(len(chars) + 1, bool)
        if len(chars):
            first[1:-1] = ~self.together[kind[:-1] * self.width + kind[1:]]
            first[ends] = True
        at = np.flatnonzero(first)
        start, size = at[:-1], np.diff(at)
        h, check = self.hashes(chars, start, size)
        return whole, start, size, h, check, np.diff(np.searchsorted(start, ends), prepend=0)


def sliced(whole: str, start: np.ndarray, size: np.ndarray) -> list[str]:
    return [whole[a:b] for a, b in zip(start.tolist(), (start + size).tolist(), strict=True)]


class Dictionary:
    """Words and their ids, in order of frequency; looked up by hash and check. The hashes are sorted; `begin` has where those
    with the same first bits begin, about one for each two entries, so that a lookup takes a step or two."""

    def __init__(self, words: list[str], ids: list[list[int]], pairs: frozenset):
        h, check = Cutter(pairs).of(words)
        h, rank = np.unique(h, return_index=True)
        self.h = np.append(h, np.uint64(0xFFFFFFFFFFFFFFFF))  # an entry without a word ends each search
        self.check, self.rank = np.append(check[rank], np.uint64(0)), np.append(rank, -1)
        bits = len(h).bit_length() + 1
        self.shift = np.uint64(64 - bits)
        self.begin = np.searchsorted(self.h, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)
        self.size = np.fromiter(map(len, ids), np.int64, len(ids))
        self.flat = np.fromiter(chain.from_iterable(ids), np.int32)
        self.pairs = pairs

    def number(self, h: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The words' numbers, -1 for those that the dictionary lacks."""
        at = self.begin[h >> self.shift]
        left = np.flatnonzero(self.h[at] < h)
        while len(left):
            at[left] += 1
            left = left[self.h[at[left]] < h[left]]
        return np.where((self.h[at] == h) & (self.check[at] == check), self.rank[at], -1)


ROWS, WORDS_HELD = 64, 1 << 19


def _counts(pairs: frozenset):
    def run(batches: Iterator) -> Iterator:
        cutter, held, size = Cutter(pairs), [], 0

        def flush():
            h, check = (np.concatenate([x[i] for x in held]) for i in (3, 4))
            _, at, back, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            odd = np.flatnonzero(check != check[at][back])  # other words with the same hash, counted one by one
            n -= np.bincount(back[odd], minlength=len(n))
            at, n = np.concatenate([at, odd]), np.concatenate([n, np.ones(len(odd), np.int64)])
            order = np.argsort(at)
            at, n = at[order], n[order]
            begin = np.cumsum([0, *(len(x[1]) for x in held)])
            for (whole, start, length, *_), a, b in zip(held, begin, begin[1:], strict=False):
                part = slice(*np.searchsorted(at, [a, b]))
                own = at[part] - a
                yield pa.RecordBatch.from_arrays([pa.array(sliced(whole, start[own], length[own]), pa.string()), pa.array(n[part], pa.int64())], names=["word", "n"])
            held.clear()

        for batch in pieces(batches, ROWS):
            held.append(cutter(columns_of(batch, "text")[0]))
            size += len(held[-1][1])
            if size > WORDS_HELD:
                yield from flush()
                size = 0
        if size:
            yield from flush()

    return run


CUT = 128


def lattices(units: DataFrame, table: Pieces) -> DataFrame:
    """Units (text, body, n) to (text, body, n, exits): the best way from the start of the text to each place from
    character `body` on, as struct (s, t) of score and ids. Pieces start before `body`; a place that none of them
    reaches has a score below -1e17."""
    parts = max(int(units.sparkSession.conf.get("spark.sql.shuffle.partitions")), units.count() // 20_000)
    places = units.repartition(parts, "text").withColumn("e", F.expr("explode(sequence(1, length(text)))"))
    for k, known in enumerate(table.ends(units.sparkSession), 1):  # as many rows as the model has pieces
        end = F.when(F.expr(f"e >= {k} and ({k} > {SHORT} or e - {k} < body)"), F.expr(f"substring(text, e - {k} + 1, {k})"))
        places = places.withColumn(f"end{k}", end).join(F.broadcast(known), f"end{k}", "left")
    # the edges that end at a place, one of each length up to SHORT; ids travel as text, which grows at less cost than an array
    place = F.expr(f"""struct(e,
      coalesce(id1, concat(-1 - ascii(substring(text, e, 1)), ',')) as id1, if(e > body, -1e18D, coalesce(s1, double({table.unknown_score!r}))) as s1,
      coalesce(id2, '') as id2, coalesce(s2, double('-Infinity')) as s2, coalesce(id3, '') as id3, coalesce(s3, double('-Infinity')) as s3,
      filter(longer, x -> e >= x.l and e - x.l < body and substring(text, e - x.l + 1, x.l) = x.piece) as longer)""")
    lattice = places.groupBy("text", "body").agg(
        F.max("n").alias("n"), F.expr("max(longer is not null) or body < length(text)").alias("far"), F.sort_array(F.collect_list(place)).alias("es")
    )
    # w1 to w3 hold the best ways to the last three places, the last one first; rest those to the places before where one can be asked for
    way = "named_struct('s', a.w{0}.s + x.s{0}, 't', concat(a.w{0}.t, x.id{0}))".format
    sums = "a.w{0}.s + x.s{0}".format
    short = f"if({sums(2)} > {sums(1)}, if({sums(3)} > {sums(2)}, {way(3)}, {way(2)}), if({sums(3)} > {sums(1)}, {way(3)}, {way(1)}))"
    none, far = "named_struct('s', double('-Infinity'), 't', '')", f"a.rest[y.l - {SHORT + 1}]"
    fold = f"""aggregate(es, named_struct('w1', named_struct('s', 0D, 't', ''), 'w2', {none}, 'w3', {none}, 'rest', cast(array() as array<struct<s: double, t: string>>)),
      (a, x) -> named_struct(
        'w1', if(x.longer is null, {short}, aggregate(x.longer, {short}, (b, y) -> if({far}.s + y.s > b.s, named_struct('s', {far}.s + y.s, 't', concat({far}.t, y.id)), b))),
        'w2', a.w1, 'w3', a.w2, 'rest', if(far, array_prepend(a.rest, a.w3), a.rest)),
      a -> transform(reverse(slice(concat(array(a.w1, a.w2, a.w3), a.rest), 1, length(text) - body + 1)),
        y -> named_struct('s', y.s, 't', transform(split(substring(y.t, 1, length(y.t) - 1), ','), p -> cast(p as int)))))"""
    return lattice.select("text", "body", "n", F.expr(fold).alias("exits"))


def chunks(words: DataFrame, longest: int) -> DataFrame:
    """Words (id, word) to (id, k, i, text, body): chunk k from its character i on, up to where the pieces can end that
    start in its `body`. The last chunk also has what is left over."""
    tail = longest - 1
    parts = words.select("id", F.expr(f"regexp_extract_all(word, '(?s).{{1,{CUT}}}', 0)").alias("p"), F.expr(f"length(word) div {CUT}").alias("m"))
    each = F.expr(
        f"posexplode(transform(sequence(1, m), k -> if(k = m, concat(p[k - 1], coalesce(get(p, k), '')), concat(p[k - 1], substring(p[k], 1, {tail})))))"
    )
    each = parts.select("id", "m", each.alias("k", "chunk")).withColumn("i", F.expr(f"explode(sequence(0, if(k = 0, 0, {tail})))"))
    return each.select("id", "k", "i", F.expr("substring(chunk, i + 1)").alias("text"), F.expr(f"cast(if(k = m - 1, length(chunk), {CUT}) - i as int)").alias("body"))


def chained(words: DataFrame, parts: DataFrame, ways: DataFrame) -> DataFrame:
    """Long words (id, word, n), their chunks and these chunks' lattices to (word, n, ids)."""
    scores = parts.join(ways.select("text", "body", F.expr("transform(exits, x -> x.s)").alias("s")), ["text", "body"])
    rows = scores.groupBy("id", "k").agg(F.expr("transform(sort_array(collect_list(struct(i, s))), x -> x.s)").alias("m"))
    rows = rows.groupBy("id").agg(F.expr("transform(sort_array(collect_list(struct(k, m))), x -> x.m)").alias("ms"))
    via = """aggregate(ms, array(named_struct('s', 0D, 'via', cast(array() as array<int>))),
      (a, m) -> transform(
        transform(sequence(0, size(m[0]) - 1), j -> array_max(transform(sequence(0, size(m) - 1), i -> named_struct('s', a[i].s + m[i][j], 'o', -i)))),
        b -> named_struct('s', b.s, 'via', concat(a[-b.o].via, array(-b.o)))),
      a -> a[0].via)"""
    via = rows.select("id", F.expr(via).alias("via"))
    steps = via.select("id", F.expr("posexplode(transform(via, (x, k) -> struct(x as i, coalesce(get(via, k + 1), 0) as j)))").alias("k", "step"))
    steps = steps.select("id", "k", "step.i", "step.j").join(parts, ["id", "k", "i"]).join(ways.select("text", "body", "exits"), ["text", "body"])
    ids = steps.groupBy("id").agg(F.expr("flatten(transform(sort_array(collect_list(struct(k, exits[j].t as t))), x -> x.t))").alias("ids"))
    return words.join(ids, "id").select("word", "n", "ids")


def segment(words: DataFrame, table: Pieces) -> DataFrame:
    """Words (word, n) to (word, n, ids) by the lattice and its Viterbi fold."""
    units = words.where(f"length(word) <= {2 * CUT}").select(F.col("word").alias("text"), F.length("word").alias("body"), "n")
    long = words.where(f"length(word) > {2 * CUT}")
    first = "exits[0].t"
    if long.isEmpty():
        return lattices(units, table).select(F.col("text").alias("word"), "n", F.expr(first).alias("ids"))
    long = written(long.withColumn("id", F.monotonically_increasing_id()), "long")
    parts = written(chunks(long, table.longest), "chunks")
    more = parts.select("text", "body").distinct().withColumn("n", F.lit(None).cast("long"))
    ways = written(lattices(units.unionByName(more), table), "lattices")
    short = ways.where("n is not null").select(F.col("text").alias("word"), "n", F.expr(first).alias("ids"))
    return short.unionByName(chained(long, parts, ways))


class Gather:
    """Concatenates runs of a flat array by index, without a loop."""

    def __init__(self, parts: list, dtype):
        self.size = np.fromiter(map(len, parts), np.int64, len(parts))
        self.flat = np.concatenate([np.asarray(p, dtype) for p in parts]) if parts else np.empty(0, dtype)
        self.start = np.cumsum(self.size) - self.size

    @classmethod
    def of(cls, flat: np.ndarray, size: np.ndarray) -> Gather:
        out = cls([], flat.dtype)
        out.flat, out.size, out.start = flat, size, np.cumsum(size) - size
        return out

    def __call__(self, at: np.ndarray) -> np.ndarray:
        size = self.size[at]
        total = int(size.sum())
        if not total:
            return self.flat[:0]
        begin = np.repeat(self.start[at] - np.cumsum(size) + size, size)
        return self.flat[begin + np.arange(total)]


def _numbered(batches: Iterator, index: Dictionary) -> Iterator:
    """Batches with their words' numbers: places in the dictionary, or -1 - k for the k-th of the words that it lacks
    in the text; then the number of words of each text, and these lacking words of each."""
    cutter = Cutter(index.pairs)
    for batch in pieces(batches, ROWS):
        whole, start, size, h, check, n = cutter(columns_of(batch, "text")[0])
        at = index.number(h, check)
        rare = np.flatnonzero(at < 0)
        ends = np.searchsorted(rare, np.cumsum(n)).tolist()
        words, lacks, codes = sliced(whole, start[rare], size[rare]), [], []
        for a, b in zip([0, *ends], ends, strict=False):
            own: dict[str, int] = {}
            codes += [-1 - own.setdefault(w, len(own)) for w in words[a:b]]
            lacks.append(list(own))
        at[rare] = codes
        yield batch, at, n, lacks


def _lacking(index):
    """Rows (d, h, pos, word): the words of a text that the dictionary lacks. Of rows with one d and h, which have one
    text, the task's first stands for all."""

    def run(batches: Iterator) -> Iterator:
        seen: set = set()
        for batch, _, _, lacks in _numbered(batches, index.value):
            for at, key in enumerate(zip(*columns_of(batch, "d", "h"), strict=True)):
                if key in seen:
                    lacks[at] = []
                elif lacks[at]:
                    if len(seen) > 1 << 18:
                        seen.clear()
                    seen.add(key)
            size = np.fromiter(map(len, lacks), np.int64, len(lacks))
            d, h = (np.repeat(batch.column(batch.schema.get_field_index(c)).to_numpy(), size) for c in ("d", "h"))
            pos = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(d), pa.array(h), pa.array(pos, pa.int32()), pa.array(list(chain.from_iterable(lacks)), pa.string())], names=["d", "h", "pos", "word"]
            )

    return run


def _coded(index):
    """Rows (doc_id, d, h, code, check): the numbers of a text, byte by byte of their places, packed."""

    def run(batches: Iterator) -> Iterator:
        pack = zstandard.ZstdCompressor(level=1)
        for batch, at, n, _ in _numbered(batches, index.value):
            texts = columns_of(batch, "text")[0]
            signed = np.where(at < 0, -2 * at - 1, 2 * at).astype("<u4").view(np.uint8).reshape(-1, 4)
            ends = np.cumsum(n).tolist()
            codes = [pack.compress(signed[a:b].T.tobytes()) for a, b in zip([0, *ends], ends, strict=False)]
            checks = [xxhash.xxh3_128_digest((t or "").encode()) for t in texts]
            known = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "d", "h")]
            yield pa.RecordBatch.from_arrays([*known, pa.array(codes, pa.binary()), pa.array(checks, pa.binary())], names=["doc_id", "d", "h", "code", "check"])

    return run


def sums_of(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of runs of n values, also of empty ones."""
    total = np.concatenate([[0], np.cumsum(x)])
    ends = np.cumsum(n)
    return total[ends] - total[ends - n]


def expanded(t: np.ndarray, n: np.ndarray, table: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids t of texts of n ids each, with -1 - c replaced by the byte pieces of character c."""
    odd = t < 0
    if not odd.any():
        return t, n
    chars, which = np.unique(t[odd], return_inverse=True)
    as_bytes = Gather([table.expand([c]) for c in chars.tolist()], np.int32)
    size = np.ones(len(t), np.int64)
    size[odd] = as_bytes.size[which]
    out = np.empty(int(size.sum()), np.int32)
    line = np.repeat(odd, size)
    out[line], out[~line] = as_bytes(which), t[~odd]
    return out, sums_of(size, n)


def _tokens(index, table):
    def run(batches: Iterator) -> Iterator:
        words, unpack = index.value, zstandard.ZstdDecompressor()
        known = table.value
        gather = Gather.of(words.flat, words.size)
        surface = Gather([np.frombuffer(known.surface.get(i, b""), np.uint8) for i in range(max(known.surface) + 1)], np.uint8)
        for batch in pieces(batches, ROWS):
            codes, checks = columns_of(batch, "code", "check")
            parts = [np.frombuffer(unpack.decompress(c), np.uint8).reshape(4, -1).T.tobytes() if c else b"" for c in codes]
            n = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
            at = np.frombuffer(b"".join(parts), "<u4").astype(np.int64)
            at = np.where(at & 1, -(at + 1) // 2, at // 2)
            # the ids of the words that the dictionary lacks, by text and place
            found = batch.column(batch.schema.get_field_index("found"))
            held = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            items = found.flatten()
            pos, lists = items.field(0).to_numpy(zero_copy_only=False).astype(np.int64), items.field(1)
            extra = Gather.of(lists.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
            rare = at < 0
            doc = np.repeat(np.arange(len(n)), n)[rare]
            base = np.concatenate([[0], np.cumsum(n)])  # a text lacks no more words than it has
            entry = np.full(base[-1], -1, np.int64)
            entry[base[np.repeat(np.arange(len(n)), held)] + pos] = np.arange(len(pos))
            own = entry[base[doc] - 1 - at[rare]]
            assert (own >= 0).all(), "a word without a lattice"
            size = np.empty(len(at), np.int64)
            size[rare], size[~rare] = extra.size[own], gather.size[at[~rare]]
            t = np.empty(int(size.sum()), np.int32)
            line = np.repeat(rare, size)
            t[line], t[~line] = extra(own), gather(at[~rare])
            t, k = expanded(t, sums_of(size, n), known)
            raw = surface(t).tobytes()
            ends = np.cumsum(sums_of(surface.size[t], k)).tolist()
            same = [xxhash.xxh3_128_digest(decoded(raw[a:b])) == c for a, b, c in zip([0, *ends], ends, checks, strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")),
                    pa.array(k, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(k)]), pa.int32()), pa.array(t, pa.int32())),
                    pa.array(same, pa.bool_()),
                ],
                names=["doc_id", "n_tokens", "token_ids", "round_trip"],
            )

    return run


def decoded(raw: bytes) -> bytes:
    """The text of joined piece surfaces: the space before the text taken off."""
    return raw[1:] if raw[:1] == b" " else raw


def decode(ids: list[int], table: Pieces) -> str:
    """The text of ids."""
    return decoded(b"".join(table.surface.get(i, b"") for i in ids)).decode("utf-8", "replace")


def encode(docs: DataFrame, model_file: str = MODEL, hot: int = 1 << 18) -> DataFrame:
    """One row for each document: doc_id, n_tokens, token_ids, round_trip."""
    spark = docs.sparkSession
    table = Pieces(model_file)
    doc = F.col("doc_id").cast("long")
    texts = docs.select(doc.alias("doc_id"), F.coalesce(doc, F.lit(0)).alias("d"), F.xxhash64(doc.isNull(), "text").alias("h"), "text")
    words = texts.select("text").mapInArrow(_counts(table.pairs), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = written(words, "words")
    known = written(segment(words, table), "segmented")
    dropped(words)
    # the words of the highest classes of frequency that fit into `hot`; found by a small table of class sizes
    level = F.floor(F.log2("n") * 16)
    short = known.where(f"length(word) <= {2 * CUT}")
    classes = short.groupBy(level.alias("level")).agg(F.count("*").alias("held")).orderBy(F.desc("level")).collect()  # at most 1024 rows
    fits = [r["level"] for r, total in zip(classes, accumulate(r["held"] for r in classes), strict=True) if total <= hot]
    top = short.where(level >= (fits[-1] if fits else 1 << 20)).select("n", "word", "ids").toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    index = spark.sparkContext.broadcast(Dictionary(top["word"].to_pylist(), top["ids"].to_pylist(), table.pairs))
    del top
    held = spark.sparkContext.broadcast(table)
    # both passes cut and number a text alike, so (d, h, pos) names a lacking word; texts and words are never joined
    rare = texts.select("d", "h", "text").mapInArrow(_lacking(index), "d long, h long, pos int, word string").join(known.select("word", "ids"), "word")
    # a table of its own, so the shuffles behind it are gone before the documents move
    found = written(rare.groupBy("d", "h").agg(F.collect_set(F.struct("pos", "ids")).alias("found")), "found")
    coded = texts.mapInArrow(_coded(index), "doc_id long, d long, h long, code binary, check binary")
    both = coded.join(found, ["d", "h"], "left").select("doc_id", "code", "check", "found")
    return both.mapInArrow(_tokens(index, held), "doc_id long, n_tokens long, token_ids array<int>, round_trip boolean")
