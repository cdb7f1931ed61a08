"""Merkle manifest of a dataset: a tree of digests per group of rows, proofs for every row, and their check.

A row's place in its group, written with digits to the base 3, says which run it belongs to on every level. Rows meet
once per block of 243 (five digits). Inside a block the digit columns are grouped away one after the other, last digit first: each grouping
nests the child structs in order and hashes their digests, so a block ends as one bounded nested struct. The blocks' digests are the
leaves of the next tier, until one node is left; the groups' digests then make up the tree above them in the same way.

Proofs come from the way back. ``transform`` walks down a nested struct with the runs above it, ``explode`` emits its leaves, and a tier's
leaves meet the next lower tier's blocks in one grouping by block. Nothing is joined. The two groupings of leaves move
digests only, never texts; the blocks of one large group lie in many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.llm.staging import staged
from framelake.operators.sequence import number_within

FAN, LEVELS = 3, 5
PATH_DDL = "array<struct<at:int,run:array<string>>>"


def encoded(col: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lower-case hex sha256 of the parts, end to end."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def row_digest(*cols: Column) -> Column:
    """A row's digest: that of its encoded columns."""
    return digest(*(encoded(c) for c in cols))


def _blocks(nodes: DataFrame, by: list[str]) -> DataFrame:
    """``(by, block, root)`` from ``(by, at, digest, item)``: ``root`` nests the block's nodes, ``at`` is a node's place in its group."""
    digits = [f"_d{k}" for k in range(LEVELS)]
    place = {d: F.expr(f"at div {FAN ** k} % {FAN}").cast("int") for k, d in enumerate(digits)}
    df = nodes.withColumns({"block": F.expr(f"at div {FAN ** LEVELS}"), **place}).drop("at").repartition(*by, "block")
    child = F.struct(F.col(digits[0]).alias("d"), "digest", "item")
    for k in range(LEVELS):
        above = ["block", *digits[k + 1:]]
        df = df.groupBy(*by, *above).agg(F.sort_array(F.collect_list(child)).alias("kids"))
        # The first run of a level with one node is all that is left of the group, so it goes up as it is.
        first = F.lit(True)
        for c in above:
            first = first & (F.col(c) == 0)
        df = df.withColumn("lone", first & (F.size("kids") == 1)).withColumn(
            "digest", F.when(F.col("lone"), F.col("kids")[0]["digest"]).otherwise(F.sha2(F.concat_ws("", "kids.digest").cast("binary"), 256)))
        child = F.struct(*([F.col(digits[k + 1]).alias("d")] if k + 1 < LEVELS else []), "digest", "lone", "kids")
    return df.select(*by, "block", child.alias("root"))


def _tiers(nodes: DataFrame, by: list[str]) -> list[DataFrame]:
    """Blocks of every tier, lowest first; the last has one block per group."""
    tiers = [staged(_blocks(nodes, by), "blocks")]
    while not tiers[-1].where("block > 0").isEmpty():
        up = tiers[-1].select(*by, F.col("block").alias("at"), F.col("root.digest").alias("digest"), F.struct(F.col("block").alias("at")).alias("item"))
        tiers.append(staged(_blocks(up, by), "blocks"))
    return tiers


def _emit(blocks: DataFrame, by: list[str]) -> DataFrame:
    """``(by, path, top, item)`` of every node of the blocks ``(by, root, path, top)``; ``path`` has the runs above, lowest first."""
    found = F.array(F.struct("path", F.col("root").alias("node")))
    for _ in range(LEVELS):
        def down(n: Column) -> Column:
            def step(kid: Column, i: Column) -> Column:
                run = F.array(F.struct(i.alias("at"), n["node"]["kids"]["digest"].alias("run")))
                return F.struct(F.when(n["node"]["lone"], n["path"]).otherwise(F.concat(run, n["path"])).alias("path"), kid.alias("node"))

            return F.transform(n["node"]["kids"], step)

        found = F.flatten(F.transform(found, down))
    return blocks.select(*by, "top", F.explode(found).alias("f")).select(*by, F.col("f.path").alias("path"), "top", "f.node.item.*")


def _descend(tiers: list[DataFrame], heads: DataFrame, by: list[str]) -> DataFrame:
    """Leaves of the lowest tier with their paths; ``heads`` has ``(by, path, top)`` of each group, where one node is left."""
    above = heads.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(tiers):
        none = [F.lit(None).cast(above.schema[c].dataType).alias(c) for c in ("path", "top")]
        both = blocks.select(*by, "block", "root", *none).union(
            above.select(*by, "block", F.lit(None).cast(blocks.schema["root"].dataType).alias("root"), "path", "top"))
        met = both.groupBy(*by, "block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("root", "path", "top")))
        leaves = _emit(met, by)
        above = leaves.withColumnRenamed("at", "block")
    return leaves


def manifest(rows: DataFrame, group: str, order: str, leaf: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``rows``: ``group``, ``order``, ``leaf``, the columns ``carry``, ``subroot``, ``root`` and ``proof``.

    ``rows`` is read more than once, so give a staged table. In a group, leaves ascend by ``order`` (nulls first, ties by ``leaf``); every
    three neighbours, on the last run fewer, become the digest of their digests, until one is left: ``subroot`` (a lone leaf itself).
    The subroots, by group (null first, bytewise), likewise give ``root``. ``proof`` is an array of ``(at, run)`` from the leaf to the
    root: all digests of the run, and the place in it of the node on the way; see :func:`fold` and :func:`siblings`. Rows that repeat
    are leaves each. No rows give no rows.
    """
    kept = (order, leaf, *carry)
    place = number_within(rows.select(group, *kept), [group], [order, leaf], out="_place")
    item = F.struct(*(F.col(c) for c in kept)).alias("item")
    tiers = _tiers(place.select(group, (F.col("_place") - 1).alias("at"), F.col(leaf).alias("digest"), item), [group])
    subroots = tiers[-1].select(group, F.col("root.digest").alias("digest"))
    place = number_within(subroots, [], [group], out="_place")
    item = F.struct(F.col(group), F.col("digest").alias("subroot")).alias("item")
    over = _tiers(place.select((F.col("_place") - 1).alias("at"), "digest", item), [])
    heads = over[-1].select(F.array().cast(PATH_DDL).alias("path"), F.struct(F.col("root.digest").alias("root")).alias("top"))
    groups = _descend(over, heads, [])
    groups = groups.select(group, "path", F.struct("subroot", "top.root").alias("top"))
    return _descend(tiers, groups, [group]).select(group, *kept, "top.subroot", "top.root", F.col("path").alias("proof"))


def siblings(proof: Column) -> Column:
    """The digests of a proof that are not on the way itself, lowest level first, left to right."""
    return F.flatten(F.transform(proof, lambda s: F.filter(s["run"], lambda _, i: i != s["at"])))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda acc, s: F.sha2(
        F.concat_ws("", F.transform(s["run"], lambda x, i: F.when(i == s["at"], acc).otherwise(x))).cast("binary"), 256))


def tamper_report(docs: DataFrame) -> DataFrame:
    """Manifest of ``documents`` by source, and whether each row's proof still leads to the root after some rows lose their line feeds.

    One row per document: ``doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified``. A leaf is the digest of ``doc_id``,
    ``source``, ``lang``, ``n_chars`` and ``text``. Where 2 divides the crc32 of the decimal ``doc_id``, the leaf that is checked is that of
    the text without line feeds; a null ``doc_id`` is never tampered with. Null columns are encoded as ``-``, null sources are
    one group, repeated rows are leaves each, and other columns are ignored.
    """
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    head = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars")]
    text = F.col("text").cast("string")
    rows = staged(docs.select("doc_id", F.col("source").cast("string").alias("source"), row_digest(*head, text).alias("leaf"),
                              row_digest(*head, F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)).alias("shown")), "leaves")
    out = manifest(rows, "source", "doc_id", "leaf", ("shown",))
    folded = fold(F.col("shown"), F.col("proof"))
    return out.select("doc_id", "source", "leaf", "subroot", "root", F.sha2(F.concat_ws("", siblings(F.col("proof"))).cast("binary"), 256).alias("proof_sha256"),
                      folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


# crc32 of the decimal doc_id, eight steps a byte; runs of three by recursion, one level a step; folding likewise.
ORACLE_MERKLE = """
with recursive
enc as (
  select doc_id, source, text,
         coalesce(strlen(doc_id::varchar) || ':' || doc_id::varchar, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars::varchar, '-') as head,
         xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(doc_id::varchar, ''), lambda ch: ord(ch)::ubigint)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), [0::ubigint, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, y: case when x % 2 = 1 then xor(x >> 1, 3988292384::ubigint) else x >> 1 end)), 4294967295::ubigint) as crc
  from documents),
tampered as (select *, case when crc % 2 = 0 then replace(text, chr(10), '') else text end as shown_text from enc),
leaves as (
  select doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
         sha256(head || coalesce(strlen(shown_text) || ':' || shown_text, '-')) as shown from tampered),
placed as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by source) as n from leaves),
low as (
  select source, 0 as lv, pos, n, leaf as digest from placed
  union all
  select source, lv + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' order by pos)) from low where n > 1 group by source, lv, n, pos // 3),
subroots as (
  select source, digest as subroot, row_number() over (order by source nulls first) - 1 as pos, count(*) over () as n from low where n = 1),
high as (
  select 0 as lv, pos, n, subroot as digest from subroots
  union all
  select lv + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' order by pos)) from high where n > 1 group by lv, n, pos // 3),
top as (select digest as root from high where n = 1),
walk as (
  select doc_id, source, pos as place, 0 as lv, false as upper_part, pos, n, shown as folded, '' as proof, leaf from placed
  union all
  select w.doc_id, w.source, w.place, case when w.n = 1 then 0 else w.lv + 1 end, w.upper_part or w.n = 1,
         case when w.n = 1 then s.pos else w.pos // 3 end, case when w.n = 1 then s.n else (w.n + 2) // 3 end,
         case when w.n = 1 then w.folded else sha256(coalesce(r.before, '') || w.folded || coalesce(r.after, '')) end,
         w.proof || case when w.n = 1 then '' else coalesce(r.before, '') || coalesce(r.after, '') end, w.leaf
  from walk w
  join subroots s on s.source is not distinct from w.source
  left join (
    select a.source, false as upper_part, a.lv, a.pos,
           string_agg(b.digest, '' order by b.pos) filter (where b.pos < a.pos) as before, string_agg(b.digest, '' order by b.pos) filter (where b.pos > a.pos) as after
    from low a join low b on a.source is not distinct from b.source and a.lv = b.lv and a.pos // 3 = b.pos // 3 and a.n > 1 group by all
    union all
    select null, true, a.lv, a.pos,
           string_agg(b.digest, '' order by b.pos) filter (where b.pos < a.pos), string_agg(b.digest, '' order by b.pos) filter (where b.pos > a.pos)
    from high a join high b on a.lv = b.lv and a.pos // 3 = b.pos // 3 and a.n > 1 group by all) r
    on r.upper_part = w.upper_part and r.lv = w.lv and r.pos = w.pos and (w.upper_part or r.source is not distinct from w.source)
  where w.n > 1 or not w.upper_part)
select w.doc_id, w.source, w.leaf, s.subroot, top.root, sha256(w.proof) as proof_sha256, w.folded as folded_root, w.folded = top.root as verified
from walk w join subroots s on s.source is not distinct from w.source cross join top
where w.upper_part and w.n = 1
"""
