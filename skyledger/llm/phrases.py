"""Phrase collocations from a weighted de Bruijn graph (operator 11).

Texts fall into pieces at sentence marks and line ends, pieces into words. Every word occurrence gives
one gram: the word and the three after it, as far as the piece goes. Equal grams are aggregated to
weighted edges from the node of their first three words to the node of their last three; a gram that the
end of its piece cuts short goes to the terminal word 0 instead and is the piece-end correction. So the
count of a phrase is the weight of all grams that begin with it: three words are a node's outgoing flow,
two words the flow of their nodes, one word the flow of its pairs, each with its own short grams.

Nodes with one way in and one way out that all their flow takes are unary. Paths of them are compacted
by pointer doubling, in which the distance known doubles each round; four-word candidates are read off
the compacted paths, and a unary node is no candidate, for the edge around it has its whole count.

Exact pruning beforehand: a phrase found `support` times has only words and pairs found as often.
Occurrences of rarer words and pairs end a run just as a piece end does, for no candidate and no part of
one reaches over them. Which words and pairs are frequent enough is told to tasks as bitmaps by
hash, at most 2^27 bits (16 MB) each whatever the corpus; a false alarm keeps a gram that is too rare, no more.

Words are known by 64-bit hashes of language and bytes. All distinct words are counted by their bytes
first; if a frequent word shares its hash with any other word, the hash is drawn anew with the next seed.

Defined results: null texts are empty, a null language is `und`; documents are taken as often as they
occur and their ids are not read; ties are broken by phrase; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm import kernels
from skyledger.llm.common import register, staged, table

SUPPORT, TOP, COVERED_PERCENT, SCALE = 30, 2000, 80, 2_000_000
NO_LANGUAGE = "und"
MAX_FILTER_BITS = 1 << 27
PATH_EDGES = 1024                     # edges of a path that one row holds
WORDS = ["w1", "w2", "w3", "w4"]
_SLICE = 1 << 19                      # bytes of text whose words are found at once: each takes some 60 bytes of arrays

_BREAKS = np.zeros(256, bool)                                        # [.,;:!?\x0A-\x0D]
_BREAKS[list(b".,;:!?\n\x0b\x0c\r")] = True
_IN_WORD = ~_BREAKS                                                  # [^\x20\x09]+ within a piece
_IN_WORD[[0x20, 0x09]] = False


def _symbols(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Words:
    """The words of consecutive documents: ids of 64 bits, and whether each begins a piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lang: list[str | None], seed: int, id_bits: int):
        self.data = kernels.LOWER[data]
        self.starts, self.ends, self.firsts = kernels.word_spans(self.data, offsets, _IN_WORD)
        own = kernels.Rolling(_symbols(seed)[self.data]).of(self.starts, self.ends) + (self.ends - self.starts).astype(np.uint64)
        names = {name: i for i, name in enumerate(dict.fromkeys(lang))}
        keys = np.array([_text_key(name, seed) for name in names] or [0], np.uint64)
        self.langs = list(names)
        self.lang = np.repeat(np.fromiter((names[x] for x in lang), np.int64, len(lang)), np.diff(self.firsts))
        ids = kernels.mixed(own ^ keys[self.lang]) >> np.uint64(64 - id_bits)
        self.ids = np.where(ids == 0, np.uint64(1), ids)             # 0 is the terminal word
        breaks = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(_BREAKS[self.data], out=breaks[1:])
        self.begins = np.ones(len(self.starts), bool)
        self.begins[1:] = breaks[self.starts[1:]] > breaks[self.ends[:-1]]
        self.begins[self.firsts[:-1][self.firsts[:-1] < len(self.starts)]] = True

    def marks(self) -> np.ndarray:
        """A second hash, of each word's length and its first and last 8 bytes, that tells words of one id apart."""
        padded = np.zeros(len(self.data) + 16, np.uint8)
        padded[8:-8] = self.data
        eight = np.lib.stride_tricks.as_strided(padded[:0].view("<u8"), (len(padded) - 7,), (1,))
        sizes = (self.ends - self.starts).astype(np.uint64)
        drop = np.uint64(8) * (np.uint64(8) - np.minimum(sizes, np.uint64(8)))
        head, tail = eight[self.starts + 8] << drop, eight[self.ends] >> drop
        return kernels.mixed(head * np.uint64(0x9E3779B97F4A7C15) ^ kernels.mixed(tail + sizes))


def _text_key(text: str, seed: int) -> int:
    data = np.frombuffer(text.encode(), np.uint8)
    return int(kernels.mixed(kernels.Rolling(_symbols(seed + 1)[data]).of(np.array([0]), np.array([len(data)])) + np.uint64(len(data)))[0])


def _sliced(batches: Iterable[pa.RecordBatch], seed: int, id_bits: int) -> Iterator[_Words]:
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for row, end, data, offsets in kernels.text_slices(batch.column(1), _SLICE):
            yield _Words(data, offsets, langs[row:end], seed, id_bits)


def _frequent(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = ids & np.uint64(len(bits) * 8 - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def _pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return kernels.mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)


def _counted(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Distinct rows of equally long columns and their counts. Columns become dense numbers, pairs of which stay under 64 bits."""
    dense = None
    for column in columns:
        _, own = np.unique(column, return_inverse=True)
        dense = own if dense is None else np.unique(dense * (own.max(initial=0) + 1) + own, return_inverse=True)[1]
    _, first, counts = np.unique(dense, return_index=True, return_counts=True)
    return [column[first] for column in columns] + [counts]


def _long(column: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(column).astype(np.uint64).view(np.int64))


def word_counts(docs: DataFrame, seed: int = 0, id_bits: int = 64) -> DataFrame:
    """(lang, word, id, f): every distinct word of each language with its occurrences."""
    @kernels.released
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _sliced(batches, seed, id_bits):
            order = np.argsort(words.ids, kind="stable")
            ids, marks = words.ids[order], words.marks()[order]
            new = np.flatnonzero(np.r_[len(ids) > 0, (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])][:len(ids)])
            first, ids, counts = order[new], ids[new], np.diff(np.r_[new, len(ids)])
            sizes = words.ends[first] - words.starts[first]
            parts = words.data[np.repeat(words.starts[first], sizes) + kernels.spread(sizes)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.langs, pa.string()).take(pa.array(words.lang[first])), kernels.binary_column(parts, sizes).cast(pa.binary()),
                 _long(ids), pa.array(counts.astype(np.int64))], ["lang", "word", "id", "f"])

    return docs.mapInArrow(run, "lang string, word binary, id long, f long").groupBy("lang", "word", "id").agg(F.sum("f").alias("f"))


def _bitmap(ids: DataFrame, column: str) -> np.ndarray:
    """A bitmap of the ids by their last bits; at most MAX_FILTER_BITS, whatever their number."""
    bits = 1 << 16
    rows = ids.count()
    while bits < min(MAX_FILTER_BITS, 16 * rows):
        bits *= 2
    at = F.col(column).bitwiseAND(F.lit(bits - 1))
    parts = ids.select(at.alias("at")).groupBy((F.col("at") / 32768).cast("long").alias("bucket")).agg(
        F.bitmap_construct_agg((F.col("at") % 32768)).alias("bits")).collect()      # 4 kB for each of at most 4096 buckets
    out = np.zeros(bits // 8, np.uint8)
    for part in parts:
        out[part.bucket * 4096:part.bucket * 4096 + 4096] = np.frombuffer(part.bits, np.uint8)
    return out


def _grams(docs: DataFrame, find: Callable[[_Words], list[np.ndarray]], names: list[str], seed: int, id_bits: int) -> DataFrame:
    @kernels.released
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _sliced(batches, seed, id_bits):
            *columns, counts = _counted(find(words))
            yield pa.RecordBatch.from_arrays([_long(c) for c in columns] + [pa.array(counts.astype(np.int64))], [*names, "f"])

    return docs.mapInArrow(run, ", ".join(f"{n} long" for n in names) + ", f long").groupBy(*names).agg(F.sum("f").alias("f"))


def _pairs(words: _Words, known) -> np.ndarray:
    """True at each word that goes on to the next one: the same piece, both frequent."""
    keep = _frequent(words.ids, known.value)
    goes = np.zeros(len(keep), bool)
    goes[:-1] = keep[:-1] & keep[1:] & ~words.begins[1:]
    return goes


def phrase_edges(docs: DataFrame, frequent_words: DataFrame, support: int, seed: int = 0, id_bits: int = 64) -> DataFrame:
    """(w1, w2, w3, w4, f): all grams of frequent words, cut short (0) at piece ends and rare pairs."""
    context = docs.sparkSession.sparkContext
    known = context.broadcast(_bitmap(frequent_words, "id"))

    def pair_columns(words: _Words) -> list[np.ndarray]:
        at = np.flatnonzero(_pairs(words, known))
        return [words.ids[at], words.ids[at + 1]]

    pairs = staged(_grams(docs, pair_columns, ["w1", "w2"], seed, id_bits).filter(F.col("f") >= support), "phrase-pairs")
    keyed = pairs.mapInArrow(_keyed_pairs, "key long")
    together = context.broadcast(_bitmap(keyed, "key"))

    def gram_columns(words: _Words) -> list[np.ndarray]:
        goes = _pairs(words, known)
        at = np.flatnonzero(goes)
        goes[at] = _frequent(_pair_keys(words.ids[at], words.ids[at + 1]), together.value)
        at, columns = np.flatnonzero(_frequent(words.ids, known.value)), []
        own, open_ = at, np.ones(len(at), bool)
        for _ in WORDS:
            columns.append(np.where(open_, words.ids[own], np.uint64(0)))
            open_ = open_ & goes[own]
            own = np.where(open_, own + 1, own)
        return columns

    return _grams(docs, gram_columns, WORDS, seed, id_bits)


def _keyed_pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        first, second = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([_long(_pair_keys(first, second))], ["key"])


def unary_nodes(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(w1, w2, w3): nodes that all their flow enters by one edge and leaves by one edge."""
    into = edges.filter("w4 <> 0").groupBy(F.col("w2").alias("w1"), F.col("w3").alias("w2"), F.col("w4").alias("w3")).agg(
        F.sum("f").alias("in_flow"), F.count(F.lit(1)).alias("ways_in"))
    return nodes.filter("ways = 1 and ends = 0").join(into, ["w1", "w2", "w3"]).filter("ways_in = 1 and in_flow = f").select("w1", "w2", "w3")


def compact_paths(edges: DataFrame, unary: DataFrame) -> DataFrame:
    """(h1..h4, part, weight, words): maximal paths through unary nodes, PATH_EDGES edges a row, named by their first edge.

    Every edge points to the one before it across a unary node; pointers are doubled until all have reached their
    path's first edge, which takes as many rounds as the logarithm of the longest path. Runs are finite, so no path is a ring.
    """
    heads, own = ["h1", "h2", "h3", "h4"], F.col
    before = edges.select(*[own(w).alias(h) for w, h in zip(WORDS, heads)], own("w2").alias("n1"), own("w3").alias("n2"), own("w4").alias("n3"))
    links = before.join(unary.select(own("w1").alias("n1"), own("w2").alias("n2"), own("w3").alias("n3")), ["n1", "n2", "n3"])
    after = edges.select(*WORDS, "f", own("w1").alias("n1"), own("w2").alias("n2"), own("w3").alias("n3"))
    linked = after.join(links, ["n1", "n2", "n3"], "left").drop("n1", "n2", "n3")
    first = own("h1").isNull()
    state = staged(linked.select(*WORDS, "f", *[F.coalesce(h, w).alias(h) for w, h in zip(WORDS, heads)],
                                 F.when(first, 0).otherwise(1).cast("long").alias("steps"), (~first).alias("moves")), "phrase-paths")
    while state.filter("moves").limit(1).count():
        there = state.select(*[own(w).alias(h) for w, h in zip(WORDS, heads)], *[own(h).alias(f"to_{h}") for h in heads],
                             own("steps").alias("more"), own("moves").alias("on"))
        moved = state.filter("moves").join(there, heads).select(
            *WORDS, "f", *[own(f"to_{h}").alias(h) for h in heads], (own("steps") + own("more")).alias("steps"), own("on").alias("moves"))
        state = staged(state.filter("not moves").unionByName(moved), "phrase-paths")
    part = F.floor(own("steps") / PATH_EDGES).alias("part")
    line = F.sort_array(F.collect_list(F.struct("steps", *WORDS)))
    return state.groupBy(*heads, part).agg(F.min("f").alias("weight"), line.alias("line")).select(
        *heads, "part", "weight", F.concat(F.expr("array(line[0].w1, line[0].w2, line[0].w3)"), F.col("line.w4")).alias("words"))


def collocations(docs: DataFrame, support: int = SUPPORT, top: int = TOP, covered: int = COVERED_PERCENT, scale: int = SCALE,
                 lang_col: str = "lang", text_col: str = "text", id_bits: int = 64) -> DataFrame:
    """Each language's best `top` phrases of two to four words found `support` times."""
    docs = docs.select(F.coalesce(F.col(lang_col), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text_col).alias("text"))
    seed = 0
    while True:
        words = staged(word_counts(docs, seed, id_bits), "phrase-words")
        if words.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("f").alias("f")).filter((F.col("n") > 1) & (F.col("f") >= support)).limit(1).count() == 0:
            break
        seed += 2
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.filter(F.col("f") >= support)
    edges = staged(phrase_edges(docs, frequent, support, seed, id_bits), "phrase-edges")
    flow = F.sum("f").alias("f")
    triples = staged(edges.groupBy("w1", "w2", "w3").agg(flow, F.count(F.lit(1)).alias("ways"), F.sum((F.col("w4") == 0).cast("int")).alias("ends")), "phrase-nodes")
    pairs = staged(triples.groupBy("w1", "w2").agg(flow), "phrase-pairs")
    singles = pairs.groupBy("w1").agg(flow)
    heavy = staged(edges.filter((F.col("w4") != 0) & (F.col("f") >= support)), "phrase-heavy")
    nodes = triples.filter((F.col("w3") != 0) & (F.col("f") >= support))
    unary = staged(unary_nodes(edges, nodes), "phrase-unary")
    none = F.lit(0).cast("long")
    counts = staged(singles.filter(F.col("f") >= support).select("w1", none.alias("w2"), none.alias("w3"), "f")
                    .unionByName(pairs.filter((F.col("w2") != 0) & (F.col("f") >= support)).select("w1", "w2", none.alias("w3"), "f"))
                    .unionByName(nodes.select("w1", "w2", "w3", "f")), "phrase-counts")
    fours = compact_paths(heavy, unary).select("weight", F.explode(F.expr(
        "transform(sequence(0, size(words) - 4), i -> struct(words[i] as w1, words[i+1] as w2, words[i+2] as w3, words[i+3] as w4))")).alias("g")).select(
        "g.*", F.col("weight").alias("f"))
    candidates = staged(counts.filter("w2 <> 0").join(unary, ["w1", "w2", "w3"], "left_anti").select("w1", "w2", "w3", none.alias("w4"), "f")
                        .unionByName(fours), "phrase-candidates")
    kept = candidates.join(_contained(candidates, fours, nodes, covered), WORDS, "left").filter("not coalesce(hidden, false)").drop("hidden")
    ranked = _scored(kept, counts, scale).join(frequent.select(F.col("id").alias("w1"), "lang"), "w1")
    best = ranked.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))).filter(F.col("place") <= top)
    named = _named(staged(best, "phrase-best"), frequent)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return named.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _contained(candidates: DataFrame, fours: DataFrame, nodes: DataFrame, covered: int) -> DataFrame:
    """(w1..w4, hidden): whether some longer candidate around a phrase has `covered` percent of its count."""
    none = F.lit(0).cast("long")
    inner = lambda df, a, b, c: df.select(F.col(a).alias("w1"), F.col(b).alias("w2"), (F.col(c) if c else none).alias("w3"), F.col("f").alias("longer"))
    parts = inner(fours, "w1", "w2", "w3").unionByName(inner(fours, "w2", "w3", "w4"))
    for df, pairs in ((fours, ("w1 w2", "w2 w3", "w3 w4")), (nodes, ("w1 w2", "w2 w3"))):
        for pair in pairs:
            parts = parts.unionByName(inner(df, *pair.split(), None))
    most = parts.groupBy("w1", "w2", "w3").agg(F.max("longer").alias("longer"))
    big = lambda c, k: F.col(c).cast("decimal(38,0)") * k
    return candidates.filter("w4 = 0").join(most, ["w1", "w2", "w3"]).filter(big("longer", 100) >= big("f", covered)).select(*WORDS, F.lit(True).alias("hidden"))


def _scored(candidates: DataFrame, counts: DataFrame, scale: int) -> DataFrame:
    """Candidates with their lowest-scoring cut: a, l, r, score."""
    cut = lambda k: (f"struct({k} as k, true as is_left, {', '.join(f'{f'w{i}' if i <= k else '0L'} as p{i}' for i in (1, 2, 3))})",
                     f"struct({k} as k, false as is_left, {', '.join(f'{f'w{k + i}' if k + i <= 4 else '0L'} as p{i}' for i in (1, 2, 3))})")
    cuts = f"case when w3 = 0 then array({', '.join(cut(1))}) when w4 = 0 then array({', '.join([*cut(1), *cut(2)])}) else array({', '.join([*cut(1), *cut(2), *cut(3)])}) end"
    parts = candidates.select(*WORDS, F.col("f").alias("a"), F.explode(F.expr(cuts)).alias("p")).select(*WORDS, "a", "p.*")
    known = counts.select(F.col("w1").alias("p1"), F.col("w2").alias("p2"), F.col("w3").alias("p3"), "f")
    sides = parts.join(known, ["p1", "p2", "p3"]).groupBy(*WORDS, "a", "k").agg(
        F.max(F.when(F.col("is_left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("is_left"), F.col("f"))).alias("r"))
    scored = sides.withColumn("score", F.expr(f"(cast(a as decimal(28,0)) * {scale}) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    return scored.groupBy(*WORDS, "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s")).select(*WORDS, "a", "s.l", "s.r", "s.score")


def _named(phrases: DataFrame, frequent: DataFrame) -> DataFrame:
    """The phrases with their words as text."""
    words = phrases.select(*WORDS, F.posexplode(F.array_remove(F.array(*WORDS), F.lit(0).cast("long"))).alias("at", "id")).join(
        frequent.select("id", F.col("word").cast("string").alias("word")), "id")
    text = words.groupBy(*WORDS).agg(F.array_join(F.expr("transform(sort_array(collect_list(struct(at, word))), x -> x.word)"), " ").alias("phrase"))
    return phrases.join(text, WORDS)


_ORACLE = """
with pieces as (
  select coalesce(lang, 'und') as lang, row_number() over () as d,
    string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n\\x0B\\x0C\\r]') as ps
  from documents where text is not null),
each as (select lang, [w for w in string_split_regex(p, '[ \\t]+') if w <> ''] as ws from (select lang, unnest(ps) as p from pieces)),
grams as (
  select lang, m, array_to_string(ws[i:i + m - 1], ' ') as phrase
  from (select lang, ws, unnest(range(1, len(ws) + 1)) as i from each where len(ws) > 0), (values (1), (2), (3), (4)) as t(m)
  where i + m - 1 <= len(ws)),
counts as (select lang, m, phrase, count(*) as f from grams group by all),
totals as (select lang, sum(f)::bigint as n from counts where m = 1 group by lang),
candidates as (select lang, m, phrase, string_split(phrase, ' ') as ws, f as a from counts where m > 1 and f >= 30),
parts as (
  select lang, m, phrase, a, k, array_to_string(ws[1:k], ' ') as left_part, array_to_string(ws[k + 1:m], ' ') as right_part
  from (select *, unnest(range(1, m)) as k from candidates)),
scored as (
  select p.lang, p.m, p.phrase, p.a, k, x.f as l, y.f as r, ((2000000::hugeint * p.a) // (x.f + y.f))::bigint as score
  from parts p join counts x on x.lang = p.lang and x.phrase = left_part and x.m = k
  join counts y on y.lang = p.lang and y.phrase = right_part and y.m = p.m - k),
cut as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_parts as (
  select lang, array_to_string(ws[i:i + s - 1], ' ') as phrase, max(a) as longer
  from (select *, unnest(range(1, m)) as i from candidates), (values (2), (3)) as t(s)
  where s < m and i + s - 1 <= m group by all
  union all
  select lang, array_to_string(ws[m - s + 1:m], ' '), max(a) from candidates, (values (2), (3)) as t(s) where s < m group by all),
hidden as (select lang, phrase, max(longer) as longer from inner_parts group by all)
select c.lang, row_number() over (partition by c.lang order by score desc, a desc, c.phrase) as rank, c.phrase, a, l, r, n, score
from cut c join totals t on t.lang = c.lang left join hidden h on h.lang = c.lang and h.phrase = c.phrase
where h.longer is null or 100 * h.longer < 80 * a
qualify rank <= 2000
"""


@register("op11_phrase_collocations", _ORACLE)
def op11_phrase_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))
