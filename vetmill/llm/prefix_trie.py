"""The prefix trie of conversations, and totals of its subtrees by parallel tree contraction.

A node is a sequence of turns that some conversation begins with; it is named by its smallest member
and its depth. Turns are never compared as texts between tasks: a prefix is known by a polynomial of
its turns' digests modulo the prime 2^127 - 1, which prefixes over any number of tasks sum up.

Places of turns come from a segmented scan: turns are dealt by ranges of (conversation, turn), so that
a conversation of any length is shared by many tasks; each task numbers and sums its own stretch, and
what a stretch must add is one row for each conversation that crosses a border.

Subtree totals come from rounds of joins over the live nodes (`contract`):

* rake: leaves leave, and what they total is added at their parents (one partial aggregation);
* compress, between conversations: a node with one live child leaves if its coin says so and its parent's
  does not; the child hangs itself to the grandparent and carries what the node had;
* compress, within a conversation: a chain of such nodes inside one block of depths leaves at once, all but
  its last node. Blocks hold at most WIDEST rows, and grow from round to round.

Every node that leaves has its total already (rake) or names the node that its total hangs on (compress);
`expand` goes back through the rounds and fills these in. Each round takes a constant share of the live nodes.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vetmill.llm import common

PRIME, BASE = (1 << 127) - 1, 0x2545F4914F6CDD1D_9E3779B97F4A7C15 % ((1 << 127) - 1)
#: Turns of another conversation that a rebuilt one may begin with.
MOST = 8
#: Depths of a block in the first round, and at most.
WIDTH, WIDEST = 512, 65536
#: Children of a node from which its row goes by broadcast (common.hot_join).
HOT_CHILDREN = 100


def _number(x: bytes | None) -> int:
    return int.from_bytes(x or b"", "big")


def _bytes(x: int) -> bytes:
    return x.to_bytes(16, "big")


def borrowed(conv_id: Column) -> Column:
    """How many turns of conversation c - c % 5 the conversation c begins with."""
    return F.crc32(conv_id.cast("string").cast("binary")) % F.lit(MOST + 1)


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), length (bytes of the text), upto (the polynomial of all turns up to this one) and
    before (up to the one before) of every turn.

    Turns go by turn, nulls first, then by the digest of role and text. Rows without conv_id are left aside."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")]
    mark = F.sha2(F.concat(F.octet_length(said[0]).cast("string"), F.lit(":"), *said), 256)
    own = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                               F.unhex(F.substring(mark, 1, 32)).alias("mark"), F.octet_length(said[1]).cast("long").alias("length")).where("conv_id is not null")
    rows = common.table(own.withColumn("row", F.monotonically_increasing_id()), "turns")
    ddl = "conv_id long, length long, chunk long, place long, upto binary, value binary"
    schema = common.arrow_schema(ddl)

    def run(batches):
        from pyspark import TaskContext

        chunk, conv, place, total, power = TaskContext.get().partitionId(), None, 0, 0, 1
        for b in batches:
            out = []
            for c, mark, length in zip(*(b[x].to_pylist() for x in ("conv_id", "mark", "length")), strict=True):
                if c != conv:
                    conv, place, total, power = c, 0, 0, 1
                place, power, value = place + 1, power * BASE % PRIME, _number(mark) % PRIME
                total = (total + value * power) % PRIME
                out.append((c, length, chunk, place, _bytes(total), _bytes(value)))
            yield common.batch(out, schema)

    order = ["conv_id", F.col("turn").asc_nulls_first(), "mark", "row"]
    local = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, ddl)
    local = common.table(local, "stretches")
    # a conversation of several stretches: at most two rows a task reach the driver
    ends = local.groupBy("conv_id", "chunk").agg(F.max(F.struct("place", "upto")).alias("last"))
    crossing = ends.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select("conv_id")
    add: dict[tuple[int, int], tuple[int, int]] = {}
    conv, places, total = None, 0, 0
    for r in ends.join(crossing, "conv_id", "left_semi").orderBy("conv_id", "chunk").collect():
        if r.conv_id != conv:
            conv, places, total = r.conv_id, 0, 0
        add[r.conv_id, r.chunk] = places, total
        total = (total + pow(BASE, places, PRIME) * _number(r["last"].upto)) % PRIME
        places += r["last"].place
    held = local.sparkSession.sparkContext.broadcast(add)
    ddl = "conv_id long, place long, length long, upto binary, before binary"
    final = common.arrow_schema(ddl)

    def shift(batches):
        add = held.value
        for b in batches:
            out = []
            for c, length, chunk, place, upto, value in zip(*(b[x].to_pylist() for x in schema.names), strict=True):
                places, total = add.get((c, chunk), (0, 0))
                here = place + places
                upto = (total + pow(BASE, places, PRIME) * _number(upto)) % PRIME if places else _number(upto)
                before = (upto - _number(value) * pow(BASE, here, PRIME)) % PRIME
                out.append((c, here, length, _bytes(upto), _bytes(before)))
            yield common.batch(out, final)

    return local.mapInArrow(shift, ddl)


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations: conv_id, depth, key and above (the prefix up to this turn and to the one
    before), length; and the conversations: conv_id, turns, end (the prefix that the whole conversation is)."""
    rows = common.table(turns(conversations), "places")
    heads = rows.where(F.col("place") <= MOST).where(F.col("conv_id") % 5 == 0)
    heads = heads.groupBy(F.col("conv_id").alias("from")).agg(F.array_sort(F.collect_list(F.struct("place", "length", "upto"))).alias("head"))
    last = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.max(F.when(F.col("place") == borrowed(F.col("conv_id")), F.col("upto"))).alias("gone"),
                                       F.max(F.struct("place", "upto"))["upto"].alias("whole"))
    convs = last.withColumns({"h": F.when(F.col("conv_id") % 5 == 0, 0).otherwise(borrowed(F.col("conv_id"))).cast("long"), "from": F.col("conv_id") - F.col("conv_id") % 5})
    convs = convs.join(heads, "from", "left")
    convs = convs.withColumn("head", F.when(F.col("h") > 0, F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("h").cast("int"))).otherwise(F.array().cast(convs.schema["head"].dataType)))
    convs = common.table(convs.select("conv_id", "n", "h", F.coalesce("gone", F.lit(b"")).alias("gone"), "whole", "head", F.size("head").cast("long").alias("m")), "conversations")
    # own turns: everything after the first h, moved to stand behind the borrowed ones
    start = F.coalesce(F.try_element_at("head", F.lit(-1))["upto"], F.lit(b""))
    shift = convs.select("conv_id", "n", "h", "m", "gone", start.alias("start"))
    own = common.hot_join(rows, shift, "conv_id", least=HOT_CHILDREN).where(F.col("place") > F.col("h"))
    names = ["conv_id", "place", "length", "upto", "before", "h", "m", "gone", "start"]
    ddl = "conv_id long, depth long, key binary, above binary, length long"
    schema = common.arrow_schema(ddl)

    def moved(h, m, gone, start, value):
        """The polynomial of a prefix that ends in an own turn."""
        return _bytes((_number(start) + pow(BASE, m - h, PRIME) * (_number(value) - _number(gone))) % PRIME)

    def run(batches):
        for b in batches:
            out = []
            for c, place, length, upto, before, h, m, gone, start in zip(*(b[x].to_pylist() for x in names), strict=True):
                if h:
                    upto, before = moved(h, m, gone, start, upto), moved(h, m, gone, start, before)
                out.append((c, place - h + m, upto, before, length))
            yield common.batch(out, schema)

    first = convs.where("m > 0").select("conv_id", "head", F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))).alias("d"))
    at = lambda d, field: F.try_element_at("head", d)[field]
    first = first.select("conv_id", F.col("d").cast("long").alias("depth"), at(F.col("d"), "upto").alias("key"),
                         F.when(F.col("d") == 1, F.lit(bytes(16))).otherwise(at(F.when(F.col("d") > 1, F.col("d") - 1).otherwise(F.lit(1)), "upto")).alias("above"),
                         at(F.col("d"), "length").alias("length"))
    all_turns = own.select(*names).mapInArrow(run, ddl).unionByName(first)
    ddl = "conv_id long, turns long, end binary"
    schema_ends = common.arrow_schema(ddl)

    def whole(batches):
        for b in batches:
            out = []
            for c, n, h, m, gone, whole, start in zip(*(b[x].to_pylist() for x in ("conv_id", "n", "h", "m", "gone", "whole", "start")), strict=True):
                end = whole if not h else moved(h, m, gone, start, whole) if n > h else (start or bytes(16))
                out.append((c, max(n - h, 0) + m, end))
            yield common.batch(out, schema_ends)

    ends = convs.select("conv_id", "n", "h", "m", "gone", "whole", start.alias("start")).mapInArrow(whole, ddl)
    return all_turns, ends


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, key, ends_sha256: the digest of the conversations that end at a node, in order, comma-joined.

    Ids are sorted by ranges and written as texts of a stretch each; the texts of a node then go through one
    digest in order. A digest is a chain by its nature: one task reads a node's texts, never holding more than one."""
    ddl = "depth long, key binary, part long, ids binary"
    schema = common.arrow_schema(ddl)

    def join(batches):
        from pyspark import TaskContext

        part, at, ids = TaskContext.get().partitionId() << 32, None, []
        for b in batches:
            out = []
            for d, key, c in zip(*(b[x].to_pylist() for x in ("turns", "end", "conv_id")), strict=True):
                if at != (d, key) or len(ids) == 4096:
                    if ids:
                        out.append((*at, part, b",".join(ids)))
                    at, ids, part = (d, key), [], part + 1
                ids.append(b"%d" % c)
            yield common.batch(out, schema)
        yield common.batch([(*at, part, b",".join(ids))] if ids else [], schema)

    order = ["turns", "end", "conv_id"]
    parts = common.table(ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, ddl), "ends")
    ddl = "depth long, key binary, ends_sha256 string"
    found = common.arrow_schema(ddl)

    def digest(batches):
        at, sha = None, None
        for b in batches:
            out = []
            for d, key, ids in zip(*(b[x].to_pylist() for x in ("depth", "key", "ids")), strict=True):
                if at != (d, key):
                    if at:
                        out.append((*at, sha.hexdigest()))
                    at, sha = (d, key), hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids)
            yield common.batch(out, found)
        yield common.batch([(*at, sha.hexdigest())] if at else [], found)

    return parts.repartition("depth", "key").sortWithinPartitions("depth", "key", "part").mapInArrow(digest, ddl)


def contract(nodes: DataFrame) -> DataFrame:
    """conv_id, depth, n_leaves, saved_tokens of every node of a tree, summed over its subtree, itself included.

    nodes: conv_id, depth (together a node's name), parent_conv_id and parent_depth (null at the root), n_children,
    saved (what a node adds itself)."""
    leaf = F.col("n_children") == 0
    live = nodes.select("conv_id", "depth", F.col("parent_conv_id").alias("p_conv"), F.col("parent_depth").alias("p_depth"), F.col("n_children").alias("kids"),
                        F.when(leaf, 1).otherwise(0).cast("long").alias("leaves"), F.col("saved"), F.lit(0).cast("long").alias("more_leaves"), F.lit(0).cast("long").alias("more_saved"))
    rounds: list[DataFrame] = []
    width, number = WIDTH, 0
    while True:
        made = common.table(_round(live, width, number), "contracted")
        rounds.append(made)
        live = made.where("state = 'live'").select(*live.columns)
        if not live.limit(1).count():
            break
        width, number = min(4 * width, WIDEST), number + 1
    return expand(rounds)


def _coin(conv: str, depth: str, number: int) -> Column:
    return F.xxhash64(conv, depth, F.lit(number)) % 2 == 0


def _round(live: DataFrame, width: int, number: int) -> DataFrame:
    """The live nodes after a round, with their state: live, done (its total is known), or hung (its total is that of
    the node to_conv, to_depth and add_leaves, add_saved; step: the later ones within the round first)."""
    gain = [F.sum(F.when(F.col("kids") == 0, F.col(x) + F.col(f"more_{x}")).otherwise(0)).alias(f"gain_{x}") for x in ("leaves", "saved")]
    child = F.min(F.when(F.col("kids") > 0, F.struct("conv_id", "depth", "more_leaves", "more_saved"))).alias("child")
    below = live.where("p_conv is not null").groupBy(F.col("p_conv").alias("conv_id"), F.col("p_depth").alias("depth")).agg(
        F.count_if(F.col("kids") > 0).alias("left"), child, *gain)
    inner = live.where("kids > 0").join(below, ["conv_id", "depth"]).select(
        "conv_id", "depth", "p_conv", "p_depth", F.col("left").alias("kids"), *[(F.col(x) + F.col(f"gain_{x}")).alias(x) for x in ("leaves", "saved")],
        "more_leaves", "more_saved", "child")
    # compress between conversations: nodes of one child that leave, and what their children take over
    goes = F.coalesce((F.col("kids") == 1) & F.col("p_conv").isNotNull() & _coin("conv_id", "depth", number) & ~_coin("p_conv", "p_depth", number), F.lit(False))
    inner = inner.withColumn("goes", goes)
    taken = inner.where("goes").select(F.col("child.conv_id").alias("conv_id"), F.col("child.depth").alias("depth"), F.col("p_conv").alias("new_conv"),
                                       F.col("p_depth").alias("new_depth"), *[(F.col(x) + F.col(f"more_{x}")).alias(f"extra_{x}") for x in ("leaves", "saved")])
    inner = inner.join(taken, ["conv_id", "depth"], "left")
    for x in ("leaves", "saved"):
        inner = inner.withColumn(f"more_{x}", F.col(f"more_{x}") + F.coalesce(f"extra_{x}", F.lit(0)))
    moved = F.col("new_conv").isNotNull()
    inner = inner.withColumns({"p_conv": F.when(moved, F.col("new_conv")).otherwise(F.col("p_conv")), "p_depth": F.when(moved, F.col("new_depth")).otherwise(F.col("p_depth"))})
    # compress within a conversation: runs of such nodes in a block of depths. The rows of a block are at most `width`.
    block = [F.col("conv_id"), F.floor((F.col("depth") + (width // 2 if number % 2 else 0)) / width), F.col("goes")]
    line = Window.partitionBy(*block).orderBy("depth")
    after = F.lead("depth").over(line)
    glued = ~F.col("goes") & (F.col("kids") == 1) & (F.col("child.conv_id") == F.col("conv_id")) & (F.col("child.depth") == after)
    inner = inner.withColumn("glued", F.coalesce(glued, F.lit(False)))
    broken = F.when(F.lag("glued", 1, False).over(line), 0).otherwise(1)
    inner = inner.withColumn("run", F.sum(broken).over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    run = Window.partitionBy(*block, "run").orderBy("depth")
    rest, whole, ahead = run.rowsBetween(Window.currentRow, Window.unboundedFollowing), run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), run.rowsBetween(1, Window.unboundedFollowing)
    more = {"top_conv": F.first("p_conv").over(whole), "top_depth": F.first("p_depth").over(whole), "end_depth": F.last("depth").over(whole)}
    for x in ("leaves", "saved"):
        own, extra = F.when(F.col("glued"), F.col(x)).otherwise(0), F.col(f"more_{x}")
        more[f"add_{x}"] = F.sum(own).over(rest) + F.coalesce(F.sum(extra).over(ahead), F.lit(0))
        more[f"sum_{x}"] = F.sum(own).over(whole) + F.sum(extra).over(whole)
    inner = inner.withColumns(more)
    alone = F.col("goes")
    hung = alone | F.col("glued")
    state = F.when(hung, "hung").otherwise("live")
    out = inner.select(
        "conv_id", "depth", F.when(hung, F.col("p_conv")).otherwise(F.col("top_conv")).alias("p_conv"), F.when(hung, F.col("p_depth")).otherwise(F.col("top_depth")).alias("p_depth"), "kids",
        "leaves", "saved", *[F.when(hung, F.col(f"more_{x}")).otherwise(F.col(f"sum_{x}")).alias(f"more_{x}") for x in ("leaves", "saved")], state.alias("state"),
        F.when(alone, 2).when(F.col("glued"), 1).alias("step"), F.when(alone, F.col("child.conv_id")).when(F.col("glued"), F.col("conv_id")).alias("to_conv"),
        F.when(alone, F.col("child.depth")).when(F.col("glued"), F.col("end_depth")).alias("to_depth"),
        *[F.when(alone, F.col(x) + F.col(f"child.more_{x}")).when(F.col("glued"), F.col(f"add_{x}")).alias(f"add_{x}") for x in ("leaves", "saved")])
    none = {c: F.lit(None) for c in ("step", "to_conv", "to_depth", "add_leaves", "add_saved")}
    raked = live.where("kids = 0").select("*", F.lit("done").alias("state"), *[v.cast(out.schema[c].dataType).alias(c) for c, v in none.items()])
    return out.unionByName(raked)


def expand(rounds: list[DataFrame]) -> DataFrame:
    """Totals of all nodes from those that left in each round, last round first."""
    kept = ["conv_id", "depth", "leaves", "saved"]
    done = None
    for made in reversed(rounds):
        known = made.where("state = 'done'").select(*kept)
        done = known if done is None else done.unionByName(known)
        for step in (1, 2):  # those that left later in the round first
            hung = made.where((F.col("state") == "hung") & (F.col("step") == step)).select("conv_id", "depth", "to_conv", "to_depth", "add_leaves", "add_saved")
            on = done.select(F.col("conv_id").alias("to_conv"), F.col("depth").alias("to_depth"), "leaves", "saved")
            filled = hung.join(on, ["to_conv", "to_depth"]).select("conv_id", "depth", (F.col("leaves") + F.col("add_leaves")).alias("leaves"), (F.col("saved") + F.col("add_saved")).alias("saved"))
            done = done.unionByName(filled)
        done = common.table(done, "totals")
    return done.select("conv_id", "depth", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node of the trie
    of rebuilt conversations.

    A null role or text is empty; null turns come first; equal turns go by a digest of role and text, so that equal
    rows all stay. Rows without conv_id are left aside, as are other columns. An empty table has no conversation,
    hence no root and no rows. Texts and conversations of any length are taken whole."""
    rows, ends = rebuilt(conversations)
    ends = common.table(ends, "ends")
    grouped = rows.groupBy("depth", "key").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("above").alias("above"), F.max("length").alias("length"))
    root = ends.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), F.lit(bytes(16)).alias("key"), "conv_id", "n_convs", F.lit(None).cast("binary").alias("above"), F.lit(0).cast("long").alias("length"))
    nodes = common.table(grouped.unionByName(root), "nodes")
    name = lambda depth, key: F.concat(F.hex(F.col(key)), F.lit("-"), F.col(depth) if isinstance(depth, str) else depth)
    nodes = nodes.select("*", name("depth", "key").alias("name"), F.when(F.col("above").isNotNull(), name(F.col("depth") - 1, "above")).alias("up"))
    children = nodes.where("up is not null").groupBy("up").agg(F.count("*").alias("n"))
    parents = common.table(children.join(nodes.select(F.col("name").alias("up"), F.col("conv_id").alias("parent_conv_id")), "up"), "parents")
    linked = common.hot_join(nodes.where("up is not null"), parents, "up", least=HOT_CHILDREN).drop("n", "up").unionByName(
        nodes.where("up is null").drop("up").withColumn("parent_conv_id", F.lit(None).cast("long")))
    linked = linked.join(parents.select(F.col("up").alias("name"), F.col("n").alias("n_children")), "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    linked = common.table(linked.join(end_digests(ends), ["depth", "key"], "left"), "linked")
    tree = linked.select("conv_id", "depth", "parent_conv_id", F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1).alias("parent_depth"), "n_children",
                         ((F.col("n_convs") - 1) * F.col("length")).alias("saved"))
    none = hashlib.sha256(b"").hexdigest()
    return linked.join(contract(tree), ["conv_id", "depth"]).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                                                                    F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
