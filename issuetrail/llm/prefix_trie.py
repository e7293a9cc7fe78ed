"""Operator 12, conversation prefix trie: nodes are found and summed up by truncation peeling, from the deepest turns to the root."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from issuetrail.llm.common import MOST, folder, table, written

#: A depth's entry in a chain: 16 bytes that name the whole sequence of turns up to it, 8 that give the code points of the last text.
NAME, ENTRY = 16, 24
ROOT = bytes(ENTRY)
NOTHING = hashlib.sha256(b"").hexdigest()


def kept_turns(conv_id: int) -> int:
    """How many turns of the group's first conversation the rebuilt one begins with."""
    return zlib.crc32(str(conv_id).encode()) % 6


def rebuilt_chains(conversations: DataFrame, band: int) -> DataFrame:
    """(conv_id, band, top, chain, ended): the rebuilt conversations as chains of entries, cut into bands of so many depths.

    The chain of band k reaches from depth k * band to `top`, both included; `ended` tells whether the conversation has no turn beyond.
    Conversations that can share turns lie together, the one that lends them first, so its first turns are held while the others stream by.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        columns = ["conv_id", "band", "top", "chain", "ended"]
        base = conv_id = None
        lent: list[tuple[bytes, int]] = []
        skip = seen = depth = 0
        chain = [ROOT]

        def grow(digest: bytes, chars: int) -> None:
            nonlocal depth, chain
            if depth and depth % band == 0:
                out.append((conv_id, depth // band - 1, depth, b"".join(chain), False))
                chain = chain[-1:]
            name = hashlib.blake2b(chain[-1][:NAME] + digest, digest_size=NAME).digest()
            chain.append(name + chars.to_bytes(8, "big"))
            depth += 1

        for batch in batches:
            for next_base, next_id, digest, chars in zip(batch["base"], batch["conv_id"], batch["digest"], batch["chars"], strict=True):
                if next_id != conv_id or next_base != base:
                    if conv_id is not None:
                        out.append((conv_id, max(0, depth - 1) // band, depth, b"".join(chain), True))
                    if next_base != base:
                        lent = []
                    base, conv_id, seen, depth, chain = next_base, next_id, 0, 0, [ROOT]
                    skip = 0 if conv_id == base else kept_turns(conv_id)
                    for turn in lent[:skip]:
                        grow(*turn)
                seen += 1
                if conv_id == base and seen <= 5:
                    lent.append((digest, chars))
                if seen > skip:
                    grow(digest, chars)
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=columns)
                out = []
        if conv_id is not None:
            out.append((conv_id, max(0, depth - 1) // band, depth, b"".join(chain), True))
        yield pd.DataFrame(out, columns=columns)

    empty = F.lit("")
    conv_id = F.col("conv_id").cast("long")
    role, text = F.coalesce("role", empty), F.coalesce("text", empty)
    turns = conversations.where(conv_id.isNotNull()).select(
        (conv_id - conv_id % 100).alias("base"),
        conv_id.alias("conv_id"),
        "turn",
        # the role's length before it tells where the text begins
        F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("digest"),
        F.char_length(text).cast("long").alias("chars"),
    )
    lends_first = F.col("conv_id") != F.col("base")
    placed = turns.repartition("base").sortWithinPartitions("base", lends_first, "conv_id", F.asc_nulls_first("turn"), "digest").drop("turn")
    return placed.mapInPandas(run, "conv_id long, band long, top long, chain binary, ended boolean")


def _name(back: int) -> Column:
    """The name in the entry so many entries from the chain's end."""
    return F.substring("chain", -ENTRY * back, NAME)


def _peel(items: dict[int, list[tuple]], merge) -> Iterator[tuple]:
    """(depth, chain, value) of each node above some items; items: by depth, (chain, value); merge: the value of a node from what meets there.

    From the deepest on, new items meet the surviving nodes, equal chains become one node, and the node survives with its last entry stripped.
    """
    surviving: dict[bytes, list] = {}
    for depth in range(max(items), -1, -1):
        nodes, surviving = surviving, {}
        for chain, value in items.get(depth, ()):
            nodes.setdefault(chain, []).append((True, value))
        for chain, met in nodes.items():
            value = merge(met)
            yield depth, chain, value
            if len(chain) > ENTRY:
                surviving.setdefault(chain[:-ENTRY], []).append((False, value))


def _peeled(rows: DataFrame, merge, names: list[str], chars: int = 8_000_000) -> DataFrame:
    """(chain, *names): what the peeling of parts of the rows (chain, *names) gives, a row for each node and part; a part has about `chars` bytes of chains."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items: dict[int, list[tuple]] = {}
        size = 0

        def given() -> pd.DataFrame:
            return pd.DataFrame([(chain, *value) for _, chain, value in _peel(items, merge)], columns=["chain", *names])

        for batch in batches:
            for chain, *value in zip(batch["chain"], *[batch[name].tolist() for name in names], strict=True):
                items.setdefault(len(chain) // ENTRY, []).append((chain, value))
                size += len(chain)
                if size > chars:
                    yield given()
                    items, size = {}, 0
        if items:
            yield given()

    return rows.select("chain", *names).mapInPandas(run, "chain binary, " + ", ".join(f"{name} long" for name in names))


def _found(met: list) -> tuple:
    """conv_id, n_convs and whether conversations go on, of a node at which conversations end or to which survivors come."""
    return min(v[0] for _, v in met), sum(v[1] for _, v in met), max((v[2] if new else 1) for new, v in met)


def _summed(met: list) -> tuple:
    """conv_id, n_convs, children, leaves, saved, and whether it is the node itself that comes.

    Nodes come once each, in whichever task; a survivor is a child if the node itself came there.
    """
    own = [v for new, v in met if new]
    below = [v for new, v in met if not new]
    least = min((v[0] for v in own), default=MOST)
    children = sum(v[2] for v in own) + sum(v[5] for v in below)
    leaves, saved = (sum(v[i] for _, v in met) for i in (3, 4))
    return least, sum(v[1] for v in own), children, leaves, saved, max((v[5] for v in own), default=0)


def peeled(ended: DataFrame, surviving: DataFrame) -> DataFrame:
    """(chain, conv_id, n_convs, n_children, n_leaves, saved_tokens) of all nodes on the chains of a band.

    ended: (chain, conv_id) of conversations that end in the band; surviving: (chain, conv_id, n_convs, n_leaves, saved_tokens) of nodes one deeper than
    the band, stripped. Tasks peel what they have and a shuffle merges the nodes they found, first to find and count nodes, then to sum up over what is
    below them; so a node that very many conversations share is one row for each part, and a band takes two shuffles however many depths it has.
    """
    none = F.lit(0).cast("long")
    both = ended.select("chain", "conv_id", (none + 1).alias("n_convs"), none.alias("goes_on"))
    both = both.union(surviving.select("chain", "conv_id", "n_convs", none + 1))
    parts = _peeled(both, _found, ["conv_id", "n_convs", "goes_on"])
    nodes = parts.groupBy("chain").agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.max("goes_on").alias("goes_on"))
    chars = F.conv(F.hex(F.substring("chain", NAME - ENTRY, ENTRY - NAME)), 16, 10).cast("long")
    own = nodes.select("chain", "conv_id", "n_convs", none.alias("n_children"), (1 - F.col("goes_on")).alias("n_leaves"), ((F.col("n_convs") - 1) * chars).alias("saved_tokens"), (none + 1).alias("itself"))
    below = surviving.select("chain", F.lit(MOST), none, none + 1, "n_leaves", "saved_tokens", none)
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    parts = _peeled(own.union(below), _summed, ["conv_id", *sums, "itself"])
    return parts.groupBy("chain").agg(F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in sums])


def ends_digests(ended: DataFrame, block: int = 4096) -> DataFrame:
    """(name, ends_sha256) of nodes at which conversations end; ended: (name, conv_id).

    A digest of a list needs it in order, so a node's ids pass through one task, in blocks of ids that aren't held together.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, digest, out = None, None, []
        for batch in batches:
            for next_name, ids in zip(batch["name"], batch["ids"], strict=True):
                if next_name != name:
                    if name is not None:
                        out.append((name, digest.hexdigest()))
                    name, digest = next_name, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=["name", "ends_sha256"])
            out = []
        if name is not None:
            yield pd.DataFrame([(name, digest.hexdigest())], columns=["name", "ends_sha256"])

    blocks = ended.groupBy("name", F.floor(F.col("conv_id") / block).alias("block")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    listed = blocks.select("name", "block", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    return listed.repartition("name").sortWithinPartitions("name", "block").select("name", "ids").mapInPandas(run, "name binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, band: int = 64) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations (conv_id, turn, role, text).

    conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Rebuilt are all ids:
    the first h turns of conversation c - c % 100, then c's own after its first h; the remainder has the sign of c. Turns are in order of turn (null first),
    then of a hash of role and text, so ties and repeated rows, which are turns of their own, have a defined order. A null role or text
    is empty. Rows without a conv_id belong to no conversation and count for none. Other columns are ignored; an empty table gives no rows.

    Peeling goes by bands of depths, the deepest first, a job for each. Rows carry the entries of their band only, so what is shuffled grows with the turns,
    however long conversations are; survivors take the next band's entries from one of their members.
    """
    spark = conversations.sparkSession
    path = folder(spark)
    rebuilt_chains(conversations, band).write.partitionBy("band").parquet(f"{path}/chains")
    chains = spark.read.schema("conv_id long, top long, chain binary, ended boolean, band long").parquet(f"{path}/chains")
    deepest = chains.agg(F.max("band")).first()[0]
    schema = "depth long, name binary, parent binary, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, band long"
    surviving = spark.createDataFrame([], schema)
    for k in range(-1 if deepest is None else deepest, -1, -1):
        own = chains.where(F.col("band") == k)
        # a band's chain begins with the last depth of the band before, whose node is not this band's but for the root
        whole = own.where(~F.col("ended")).select("conv_id", "chain")
        nodes = peeled(own.where("ended").select("chain", "conv_id"), surviving.join(whole, "conv_id"))
        nodes = nodes.withColumn("depth", F.length("chain") / ENTRY - 1 + k * band).where(F.col("depth") > (k * band if k else -1))
        parent = F.when(F.col("depth") > 0, _name(2))
        nodes = nodes.select(F.col("depth").cast("long"), _name(1).alias("name"), parent.alias("parent"), *nodes.columns[1:-1])
        nodes.write.parquet(f"{path}/nodes/band={k}")
        surviving = spark.read.schema(schema).parquet(f"{path}/nodes").where((F.col("band") == k) & (F.col("depth") == k * band + 1))
    nodes = surviving if deepest is None else spark.read.schema(schema).parquet(f"{path}/nodes")
    ended = chains.where("ended").select(_name(1).alias("name"), "conv_id")
    digests = written(ends_digests(ended))
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(parents, "parent", "left").join(digests, "name", "left")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return found.select(*columns, F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


#: A node is the list of its turns; CRC-32 bit by bit; each node's share of saved code points goes to all nodes that begin it.
SQL = """
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
        {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS turn
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list(turn ORDER BY pos) AS turns,
        xor(4294967295::BIGINT, list_reduce(
            list_prepend(4294967295::BIGINT, [(CASE WHEN i % 8 = 0 THEN ord(substr(CAST(conv_id AS VARCHAR), (i // 8 + 1)::INT, 1)) ELSE 0 END)::BIGINT
                FOR i IN range(8 * length(CAST(conv_id AS VARCHAR)))]),
            lambda crc, byte: xor(xor(crc, byte) >> 1, (xor(crc, byte) & 1) * 3988292384::BIGINT)
        )) % 6 AS h
    FROM turns GROUP BY conv_id
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
    FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
), nodes AS (
    SELECT turns[1:d] AS path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        list(conv_id ORDER BY conv_id) FILTER (WHERE d = len(turns)) AS ends
    FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM rebuilt) GROUP BY ALL
), counted AS (
    SELECT p.path, p.depth, p.conv_id, p.n_convs, p.ends, count(c.depth) AS n_children
    FROM nodes p LEFT JOIN nodes c ON c.depth = p.depth + 1 AND c.path[1:p.depth] = p.path GROUP BY ALL
), above AS (
    SELECT path[1:d] AS path, sum((n_convs - 1) * coalesce(length(path[depth].text), 0)) AS saved, count(*) FILTER (WHERE n_children = 0) AS n_leaves
    FROM (SELECT *, unnest(range(depth + 1)) AS d FROM counted) GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, a.n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens,
    sha256(coalesce(array_to_string(n.ends, ','), '')) AS ends_sha256
FROM counted n JOIN above a ON a.path = n.path LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
"""
