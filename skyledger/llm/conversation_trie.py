"""A prefix trie of conversations by ROLLUP (operator 12).

Turns become ids of 24 bytes: 16 of the SHA-256 of role and text, 8 of the text's size. A conversation is laid
out in rows of `BLOCK` positional columns t1 ... t8, and one SQL ROLLUP over them aggregates all prefixes at once:
grouping_id tells how many turns a group's prefix has, and groups whose last turn is missing are left out. Longer
conversations go on in further rows, keyed by the node that the row before ended at. That node's key is a digest of
the whole prefix, found for all rows together by doubling (each round joins a row with the one twice as far
before it), so the rounds grow with the logarithm of the longest conversation.

The ROLLUP runs twice. First it gives every node's smallest member: since a child's members are some of its parent's, the
nodes that a conversation is smallest in are the last ones on its path. With C(d) the bytes of its first d turns and s
the depth where they begin, the nodes under N save sum(max(0, C(s-1) - C(depth(N)-1))) over N's members, because
every node's bytes count once for each member but its smallest; and the leaves under N are members that are smallest in a
childless end. Both are plain sums in the second ROLLUP, so no step climbs the trie level by level.

The digest of a node's ends is sequential by definition: ids are sorted and joined to text in ranges by all tasks, and one
task a node hashes the texts in turn, holding one stretch at a time.

Defined results: a null role or text is empty; turns with a null conversation belong to none and are left out; turns of one number
go by role, the text's first 64 characters, then their id; repeated turns are taken as often as they
occur; an empty table gives no rows (not even the root); conv_id % 5 has the sign of conv_id; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import register, staged, table

BLOCK = 8
SHARED_BY, MAX_SHARED = 5, 9           # conversation c begins with some turns of c - c % 5: crc32(c) % 9 of them
_ENDS_TEXT = 1 << 20                   # bytes of ids joined to one text
_TURNS = [f"t{i}" for i in range(1, BLOCK + 1)]


def turn_ids(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, t): each conversation's turns in order, numbered from 0, without gathering one in a task.

    Turns are dealt by ranges of their order and numbered within each; counts of a conversation's earlier ranges are added.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    size = F.octet_length(text)
    digest = F.substring(F.unhex(F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), F.concat(role, text)).cast("binary"), 256)), 1, 16)
    t = F.concat(digest, F.unhex(F.lpad(F.hex(size.cast("long")), 16, "0")))
    rows = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.substring(text, 1, 64).alias("head"), t.alias("t"))
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("head"), F.asc("t")]
    salted = rows.withColumn("came_from", F.spark_partition_id())
    dealt = staged(salted.repartitionByRange(*order, F.asc("came_from")).select(*rows.columns, F.spark_partition_id().alias("cell")), "trie-turns")
    before = dealt.groupBy("conv_id", "cell").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "cell", F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("conv_id", "cell").orderBy(*order[1:]))
    return dealt.withColumn("place", place).join(before, ["conv_id", "cell"]).select("conv_id", (F.col("before") + F.col("place") - 1).alias("pos"), "t")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, n, pos, t): each conversation begins with the first turns of the one that it shares them with; one of
    no turns at all has one row with neither."""
    owner = (F.col("conv_id") - F.col("conv_id") % SHARED_BY).alias("owner")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MAX_SHARED).alias("h")
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("there"))
    shared = sizes.select(F.col("conv_id").alias("owner"), F.col("there").alias("offered"))
    given = F.least("h", F.coalesce("offered", F.lit(0)))
    convs = staged(sizes.select("conv_id", "there", owner, h).join(shared, "owner", "left").select(
        "conv_id", "owner", "h", given.alias("given"), (given + F.greatest(F.col("there") - F.col("h"), F.lit(0))).alias("n")), "trie-conversations")
    first = turns.filter(F.col("pos") < MAX_SHARED - 1).select(F.col("conv_id").alias("owner"), "pos", "t")
    begun = convs.join(first, "owner").filter("pos < given").select("conv_id", "n", "pos", "t")
    own = turns.join(convs, "conv_id").filter("pos >= h").select("conv_id", "n", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "t")
    none = convs.filter("n = 0").select("conv_id", "n", F.lit(None).cast("long").alias("pos"), F.lit(None).cast("binary").alias("t"))
    return begun.unionByName(own).unionByName(none)


def blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, n, block, prior, own, c0, t1 ... t8): rows of BLOCK turns; `prior` is the key of the node before the row, `own` of
    the one at its end where the row is full, c0 the bytes of all turns before."""
    block, slot = F.coalesce((F.col("pos") / BLOCK).cast("long"), F.lit(0)).alias("block"), F.col("pos") % BLOCK
    wide = turns.groupBy("conv_id", "n", block).agg(*[F.max(F.when(slot == i, F.col("t"))).alias(c) for i, c in enumerate(_TURNS)])
    here = sum((size_of(F.col(c)) for c in _TURNS), F.lit(0).cast("long"))
    full = F.col("n") >= (F.col("block") + 1) * BLOCK
    rows = staged(wide.withColumn("path", F.when(full, node_key(F.lit(b""), F.col("block"), _TURNS))).withColumn("upto", here), "trie-rows")
    state, reach = rows.filter(F.col("n") > BLOCK), 1
    longest = state.agg(F.max("block")).first()[0] or 0
    while reach <= longest:                                          # a path covers 2 * reach rows after this round, or all before its own
        back = state.filter(F.col("path").isNotNull()).select("conv_id", (F.col("block") + reach).alias("block"), F.col("path").alias("far"), F.col("upto").alias("far_upto"))
        state = staged(state.join(back, ["conv_id", "block"], "left").withColumn("path", F.when(F.col("far").isNull(), F.col("path")).otherwise(digest("far", "path")))
                       .withColumn("upto", F.col("upto") + F.coalesce("far_upto", F.lit(0))).drop("far", "far_upto"), "trie-rows")
        reach *= 2
    before = state.filter(F.col("path").isNotNull()).select("conv_id", (F.col("block") + 1).alias("block"), F.col("path").alias("prior"))
    columns = ["conv_id", "n", "block", F.coalesce("prior", F.lit(b"")).alias("prior"), F.col("path").alias("own"), (F.col("upto") - here).alias("c0"), *_TURNS]
    alone = rows.filter(F.col("n") <= BLOCK).withColumn("prior", F.lit(None).cast("binary"))
    return staged(state.join(before, ["conv_id", "block"], "left").select(*columns).unionByName(alone.select(*columns)), "trie-rows")


def digest(*parts: Column | str) -> Column:
    """16 bytes of the SHA-256 of parts of fixed lengths; null if a part is."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def node_key(prior: Column, block: Column, turns: list[str]) -> Column:
    """The key of the node that the turns there are lead to from `prior`."""
    return digest(prior, F.unhex(F.lpad(F.hex(block), 16, "0")), *[F.coalesce(F.col(c), F.lit(b"")) for c in turns])


def size_of(turn: Column) -> Column:
    """The bytes of a turn's text, from its id; 0 for a missing turn."""
    return F.coalesce(F.conv(F.hex(F.substring(turn, 17, 8)), 16, 10).cast("long"), F.lit(0))


def rollup(rows: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Every prefix of the rows once, by one ROLLUP over the positions: its `level` (turns kept of the row), depth, members and `sums`.

    Null turns of short conversations and those rolled up are told apart by grouping_id; the last turn kept must be there.
    The empty prefix of a further row is a node of the row before already.
    """
    extra = "".join(f", {expression} as {name}" for name, expression in sums.items())
    grouped = rows.sparkSession.sql(f"""
        select block, prior, {', '.join(_TURNS)}, {BLOCK} - bit_count(grouping_id()) as level, count(*) as n_convs, max(own) as own, min(c0) as c0{extra}
        from {{rows}} group by block, prior, rollup({', '.join(_TURNS)})""", rows=rows)
    there = " or ".join(["(level = 0 and block = 0)", *[f"(level = {i} and t{i} is not null)" for i in range(1, BLOCK + 1)]])
    return grouped.filter(there).withColumn("depth", F.col("block") * BLOCK + F.col("level"))


def spent(level: int) -> Column:
    """The bytes of the turns before the last one of a prefix of a row."""
    return sum((size_of(F.col(c)) for c in _TURNS[:max(level - 1, 0)]), F.col("c0"))


def by_level(of, first: int = 0) -> Column:
    """A value that is another expression for each level."""
    out = F.lit(None)
    for level in range(first, BLOCK + 1):
        out = F.when(F.col("level") == level, of(level)).otherwise(out)
    return out


def key_at(level: int) -> Column:
    return F.lit(b"") if level == 0 else F.col("own") if level == BLOCK else node_key(F.col("prior"), F.col("block"), _TURNS[:level])


def trie(conversations: DataFrame) -> DataFrame:
    """All nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = blocks(rebuilt(turn_ids(conversations)))
    # the depth and the bytes before the nodes that a conversation is smallest in, and whether its end is a leaf that it stands for
    owned = rollup(rows, {"conv_id": "min(conv_id)", "longest": "max(n)"}).select(
        "conv_id", "depth", (F.col("longest") == F.col("depth")).alias("is_leaf"), by_level(spent).alias("spent")).groupBy("conv_id").agg(
        F.min("depth").alias("since"), F.min("spent").alias("shared"), F.max("is_leaf").alias("stands"))
    whole = rows.groupBy("conv_id").agg(F.max(spent(BLOCK + 1)).alias("all_bytes"))
    facts = whole.join(owned, "conv_id", "left").select("conv_id", "since", F.coalesce("shared", "all_bytes").alias("shared"), F.coalesce("stands", F.lit(False)).cast("long").alias("leaf"))
    known = rows.join(facts, "conv_id")
    for level in range(BLOCK + 1):
        known = known.withColumn(f"saved{level}", F.greatest(F.col("shared") - (spent(level) if level else F.lit(0)), F.lit(0)))
    sums = {f"saved{level}": f"sum(saved{level})" for level in range(BLOCK + 1)}
    found = rollup(known, {"least": "min(struct(conv_id, since))", "n_leaves": "sum(leaf)", **sums})
    nodes = staged(found.select(
        by_level(key_at).alias("key"), by_level(lambda k: F.col("prior") if k == 1 else key_at(k - 1), 1).alias("parent"), "depth", "least.conv_id", "least.since",
        "n_convs", "n_leaves", by_level(lambda k: F.col(f"saved{k}")).alias("saved_tokens")), "trie-nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    # a child with another smallest member than its parent's is the first that its member is smallest in
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("above"))
    named = nodes.filter("depth > since").withColumn("above", F.col("conv_id")).unionByName(nodes.filter("depth = since").join(above, "parent", "left").select(*nodes.columns, "above"))
    nothing = hashlib.sha256().hexdigest()
    return named.join(children, "key", "left").join(ends(rows), "key", "left").select(
        "conv_id", F.col("depth").cast("long"), F.when(F.col("depth") > 0, F.col("above")).alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def ends(rows: DataFrame) -> DataFrame:
    """(key, ends_sha256): the digest of the ids of the conversations that end at a node, in ascending order."""
    last = rows.filter(F.col("n") <= (F.col("block") + 1) * BLOCK).select(
        F.when(F.col("n") == 0, F.lit(b"")).when(F.col("own").isNotNull(), F.col("own")).otherwise(node_key(F.col("prior"), F.col("block"), _TURNS)).alias("key"), "conv_id")
    texts = last.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_joined_ids, "key binary, least long, text string")
    return texts.repartition("key").sortWithinPartitions("key", "least").mapInArrow(_hashed, "key binary, ends_sha256 string")


def _joined_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids of one node as texts of bounded length."""
    for batch in batches:
        out: list[tuple[bytes, int, list[str]]] = []
        size = 0
        for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not out or out[-1][0] != key or size >= _ENDS_TEXT:
                out.append((key, conv, []))
                size = 0
            out[-1][2].append(str(conv))
            size += len(out[-1][2][-1]) + 1
        keys, least, ids = zip(*out, strict=True) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(least, pa.int64()), pa.array([",".join(x) for x in ids], pa.string())], ["key", "least", "text"])


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's texts, one after another."""
    open_key, state, done = None, None, []
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if key == open_key:
                state.update(b",")
            else:
                if state is not None:
                    done.append((open_key, state.hexdigest()))
                open_key, state = key, hashlib.sha256()
            state.update(text.encode())
        yield _digests(done)
        done = []
    if state is not None:
        yield _digests([(open_key, state.hexdigest())])


def _digests(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())], ["key", "ends_sha256"])


_ORACLE = """
with turns as (
  select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as pos, coalesce(role, '') as role, coalesce(text, '') as txt
  from conversations where conv_id is not null),
convs as (
  select c, count(*) as there, c - c % 5 as owner,
    xor(list_reduce([4294967295] || [ascii(x)::bigint for x in string_split(c::varchar, '')],
      lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)), 4294967295) % 9 as h
  from turns group by c),
rebuilt as (
  select x.c, t.pos, role, txt from convs x join turns t on t.c = x.owner and t.pos < x.h
  union all
  select x.c, t.pos - x.h + least(x.h, coalesce(o.there, 0)), role, txt from convs x join turns t on t.c = x.c and t.pos >= x.h left join convs o on o.c = x.owner),
lines as (
  select convs.c, coalesce(list(sha256(strlen(role) || ':' || role || txt) order by pos) filter (where pos is not null), []) as hs,
    coalesce(list(strlen(txt) order by pos) filter (where pos is not null), []) as sizes
  from convs left join rebuilt on rebuilt.c = convs.c group by convs.c),
members as (select c, d, len(hs) as n, array_to_string(hs[1:d], '') as key, case when d > 0 then sizes[d] else 0 end as size from (select *, unnest(range(0, len(hs) + 1)) as d from lines)),
nodes as (
  select key, d, min(c) as conv_id, count(*) as n_convs, any_value(size) as size, max(n) = d as leaf,
    sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where n = d), '')) as ends_sha256
  from members group by key, d)
select n.conv_id, n.d::bigint as depth, any_value(p.conv_id) as parent_conv_id, n.n_convs, count(*) filter (where m.d = n.d + 1) as n_children,
  count(*) filter (where m.leaf) as n_leaves, sum((m.n_convs - 1) * m.size)::bigint as saved_tokens, n.ends_sha256
from nodes n join nodes m on m.d >= n.d and starts_with(m.key, n.key)
left join nodes p on p.d = n.d - 1 and starts_with(n.key, p.key)
group by n.key, n.conv_id, n.d, n.n_convs, n.ends_sha256
"""


@register("op12_conversation_trie", _ORACLE)
def op12_conversation_trie(spark, sf_dir):
    return trie(table(spark, sf_dir, "conversations"))
