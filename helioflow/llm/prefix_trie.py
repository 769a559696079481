"""Trie of conversation prefixes by composable fingerprints.

A sequence of turns stands for the pair (n, s): its length and the sum of ``hash(turn j) * B^j`` modulo
a prime. Pairs compose: (n, s) and (m, t) make (n + m, s + B^n * t), and a head can be taken off
again by the inverse power. So every prefix of a rebuilt conversation (the head of its base, then
its own turns) has its fingerprint from the stored running products of the two conversations; no rebuilt text
is made. Three primes near 2^31 give some 90 bits.

1. Turns are put in order by ranges, so that a conversation of any length is spread over tasks; running
   products are made within a range and composed with what the ranges before it carry.
2. Rebuilt prefixes, a narrow row for each (conversation, depth), are grouped by depth and fingerprint.
3. Equality is verified through the stored turns: rows of one turn hash must have one role and text,
   and all members of a prefix group one last turn; parents' groups are checked likewise, so by
   induction the whole prefixes are equal. If a check fails, another base and hash seed is taken.
4. Sums over subtrees come from members, not from descents: see ``_sums``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helioflow.llm.common import stored

#: Primes below 2^31: products of two residues fit in 64 bits.
PRIMES = (2_147_483_647, 2_147_483_629, 2_147_483_587)
#: Ids of one such range are joined to one string by one task.
ENDS = 8192
KEY = ["d", "f0", "f1", "f2"]


def _power(base: int, exponent: Column, p: int) -> Column:
    """base^exponent modulo p, for exponents from 0 to 2^31 - 1."""
    squares = [base % p]
    for _ in range(30):
        squares.append(squares[-1] ** 2 % p)
    step = lambda done, k: F.when(F.getbit(exponent, k) == 1, done * F.get(F.lit(squares), k) % p).otherwise(done)
    return F.aggregate(F.sequence(F.lit(0), F.lit(30)), F.lit(1).cast("long"), step)


def _bases(seed: int) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{seed}:{p}".encode()).digest()[:8], "big") % (p - 2) + 2 for p in PRIMES]


def stored_turns(turns: DataFrame, seed: int) -> DataFrame:
    """``c, at, role, text, th, chars``: turns with the order of all of them, and their hashes."""
    plain = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in ("role", "text"))
    )
    first = [F.col("c"), F.col("turn").asc_nulls_first()]
    # Range bounds go to the driver, so they hold beginnings of texts only; ties of these stay together.
    dealt = plain.repartitionByRange(*first, F.substring("role", 1, 64), F.substring("text", 1, 64)).sortWithinPartitions(*first, "role", "text")
    return stored(
        dealt.withColumn("at", F.monotonically_increasing_id()).select("c", "at", "role", "text", F.xxhash64(F.lit(seed), "role", "text").alias("th"), F.length("text").cast("long").alias("chars"))
    )


def running_products(ordered: DataFrame, bases: list[int]) -> DataFrame:
    """``c, i, th, chars, total, s0..s2``: each turn's place from 1, with length and sums up to it."""
    ks = range(len(PRIMES))
    part = ordered.select("c", "at", F.shiftright("at", 33).alias("part"), "th", "chars")
    so_far = Window.partitionBy("part", "c").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    terms = part.withColumn("k", F.row_number().over(Window.partitionBy("part", "c").orderBy("at")).cast("long"))
    terms = terms.withColumns({f"s{j}": F.pmod("th", F.lit(PRIMES[j])) * _power(bases[j], F.col("k"), PRIMES[j]) % PRIMES[j] for j in ks})
    local = terms.withColumns({f"s{j}": F.sum(f"s{j}").over(so_far) % PRIMES[j] for j in ks} | {"total": F.sum("chars").over(so_far)})
    # One row for each range that a conversation is in, which are few even for the longest.
    ends = local.groupBy("c", "part").agg(F.max("k").alias("n"), F.max("total").alias("own"), *(F.max_by(f"s{j}", "k").alias(f"s{j}") for j in ks))
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda x: F.coalesce(F.sum(x).over(before), F.lit(0))
    ends = ends.withColumns({"n0": earlier("n"), "total0": earlier("own")})
    ends = ends.withColumns({f"t{j}": F.col(f"s{j}") * _power(bases[j], F.col("n0"), PRIMES[j]) % PRIMES[j] for j in ks})
    carried = ends.select("c", "part", "n0", "total0", *(earlier(f"t{j}").alias(f"c{j}") for j in ks))
    both = local.join(carried, ["part", "c"])
    sums = [((F.col(f"c{j}") + F.col(f"s{j}") * _power(bases[j], F.col("n0"), PRIMES[j])) % PRIMES[j]).alias(f"s{j}") for j in ks]
    return both.select("c", (F.col("n0") + F.col("k")).alias("i"), "th", "chars", (F.col("total0") + F.col("total")).alias("total"), *sums)


def rebuilt_prefixes(products: DataFrame, bases: list[int], base: Callable[[Column], Column], head: Callable[[Column], Column], most_head: int) -> DataFrame:
    """``c, d, f0..f2, th, chars, total, n, ref, place``: a row for each prefix of each rebuilt conversation.

    ``base`` and ``head`` give, for a conversation's id, whose first turns it takes and how many, ``most_head`` at most. ``n``
    is the rebuilt length; the last turn of the prefix is turn ``place`` of conversation ``ref``.
    """
    ks = range(len(PRIMES))
    sums = [f"s{j}" for j in ks]
    heads = products.where(F.col("i") <= max(most_head, 1)).groupBy("c").agg(F.array_sort(F.collect_list(F.struct("i", "th", "chars", "total", *sums))).alias("first"))
    own = products.groupBy("c").agg(F.max("i").alias("n_own")).join(heads, "c")
    asks = own.withColumns({"b": base(F.col("c")), "h": head(F.col("c")).cast("long")})
    both = asks.join(own.select(F.col("c").alias("b"), F.col("first").alias("given")), "b", "left")
    both = both.withColumn("given", F.coalesce(F.expr("slice(given, 1, cast(h as int))"), F.expr("slice(first, 1, 0)"))).withColumns({
        "hb": F.size("given").cast("long"), "left": F.greatest(F.col("n_own") - F.col("h"), F.lit(0)), "skip": F.get("first", F.least("h", "n_own").cast("int") - 1), "join": F.get("given", F.size("given") - 1),
    })
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    inverse = [[pow(pow(bases[j], -1, PRIMES[j]), x, PRIMES[j]) for x in range(most_head + 1)] for j in ks]
    convs = stored(both.select(
        "c", "b", "h", "hb", "given", (F.col("hb") + F.col("left")).alias("n"), *(zero(F.col("join")[f"s{j}"]).alias(f"b{j}") for j in ks), *(zero(F.col("skip")[f"s{j}"]).alias(f"k{j}") for j in ks),
        zero(F.col("join")["total"]).alias("b_total"), zero(F.col("skip")["total"]).alias("k_total"),
    ))
    none = F.lit(0).cast("long")
    fs = [f"f{j}" for j in ks]
    root = convs.select("c", none.alias("d"), *(none.alias(f) for f in fs), none.alias("th"), none.alias("chars"), none.alias("total"), "n", F.lit(None).cast("long").alias("ref"), none.alias("place"))
    shared = convs.select("c", "n", "b", F.explode("given").alias("t")).select(
        "c", F.col("t.i").alias("d"), *(F.col(f"t.s{j}").alias(f"f{j}") for j in ks), "t.th", "t.chars", "t.total", "n", F.col("b").alias("ref"), F.col("t.i").alias("place")
    )
    suffix = products.join(convs.drop("given", "b"), "c").where(F.col("i") > F.col("h"))
    shift = [F.get(F.lit(inverse[j]), (F.col("h") - F.col("hb")).cast("int")) for j in ks]
    moved = [((F.col(f"b{j}") + (F.col(f"s{j}") + PRIMES[j] - F.col(f"k{j}")) % PRIMES[j] * shift[j]) % PRIMES[j]).alias(f"f{j}") for j in ks]
    tail = suffix.select("c", (F.col("hb") + F.col("i") - F.col("h")).alias("d"), *moved, "th", "chars", (F.col("b_total") + F.col("total") - F.col("k_total")).alias("total"), "n", F.col("c").alias("ref"), F.col("i").alias("place"))
    return root.unionByName(shared).unionByName(tail)


def _equal(ordered: DataFrame, nodes: DataFrame) -> bool:
    """Whether turns of one hash are the same turn, and the members of each group end with the same one."""
    if not nodes.where("least_th <> most_th").isEmpty():
        return False
    repeated = ordered.groupBy("th").count().where("count > 1").select("th")
    turn = F.struct("role", "text")
    kinds = ordered.join(repeated, "th", "left_semi").groupBy("th").agg(F.min(turn).alias("a"), F.max(turn).alias("z"))
    return kinds.where("a <> z").isEmpty()


def _sums(prefixes: DataFrame, nodes: DataFrame) -> DataFrame:
    """``KEY, n_leaves, saved_tokens`` of each node's subtree.

    A leaf counts once, at its smallest member. What a subtree saves is the characters of all its members'
    turns from its top on, less those of its nodes; a node is put to its smallest member, and one conversation is
    the smallest of its path's nodes from some depth on. So a member adds the characters from the
    node's own turn to the turn from which on the path is its own, and no node needs its ancestors.
    """
    several = nodes.where("n_convs > 1").select(*KEY, F.col("conv_id").alias("owner"), "deepest")
    met = prefixes.join(several, KEY, "left").withColumn("own", F.coalesce(F.col("owner") == F.col("c"), F.lit(True)))
    ends = (F.col("d") == F.col("n")) & F.col("own") & (F.coalesce("deepest", "n") == F.col("d"))
    each = met.groupBy("c").agg(F.coalesce(F.max(F.when(~F.col("own"), F.col("total"))), F.lit(0)).alias("with_others"), F.max(ends.cast("long")).alias("leaf"))
    more = F.greatest(F.col("with_others") - F.col("total") + F.col("chars"), F.lit(0))
    return prefixes.join(each, "c").groupBy(*KEY).agg(F.sum("leaf").alias("n_leaves"), F.sum(more).alias("saved_tokens"))


def _ends(prefixes: DataFrame) -> DataFrame:
    """``KEY, ends_sha256`` of the nodes where some conversation ends.

    Ids are distinct, so a range of ``ENDS`` ids has no more members than that; ranges are joined to strings each in its own
    group. A node of several ranges is hashed as a stream of these, in order, which takes little memory.
    """
    last = prefixes.where("d = n").groupBy(*KEY, F.floor(F.col("c") / ENDS).alias("span")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda c: c.cast("string")), ",").alias("ids"))
    last = stored(last)
    spans = last.groupBy(*KEY).agg(F.count("*").alias("n_spans"), F.first("ids").alias("ids"))
    one = spans.where("n_spans = 1").select(*KEY, F.sha2("ids", 256).alias("ends_sha256"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        out = lambda: pa.RecordBatch.from_pylist([dict(zip(KEY, key, strict=True)) | {"ends_sha256": state.hexdigest()}], schema=wanted)
        for batch in batches:
            for row in zip(*(batch.column(x).to_pylist() for x in [*KEY, "ids"]), strict=True):
                if row[:-1] != key:
                    if state is not None:
                        yield out()
                    key, state = row[:-1], hashlib.sha256(row[-1].encode())
                else:
                    state.update(b"," + row[-1].encode())
        if state is not None:
            yield out()

    wanted = pa.schema([(k, pa.int64()) for k in KEY] + [("ends_sha256", pa.string())])
    many = last.join(spans.where("n_spans > 1").select(*KEY), KEY, "left_semi").repartition(*KEY).sortWithinPartitions(*KEY, "span").select(*KEY, "ids")
    return one.unionByName(many.mapInArrow(hashed, ", ".join(f"{k} long" for k in KEY) + ", ends_sha256 string"))


def prefix_trie(turns: DataFrame, base: Callable[[Column], Column], head: Callable[[Column], Column], most_head: int) -> DataFrame:
    """The trie of all rebuilt conversations of ``turns`` (``conv_id, turn, role, text``), a row for each node.

    Conversation c is rebuilt as the first ``head(c)`` turns of conversation ``base(c)`` and its own turns
    after its first ``head(c)``. Turns are ordered by ``turn`` (null first), then role and text; null role or
    text is empty; rows without conv_id take no part; repeated rows are turns of their own; other columns
    are not read. Empty input: no rows.

    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``, and ``ref_conv, ref_turn``: where the node's last turn is stored.
    """
    ks = range(len(PRIMES))
    for seed in range(42, 62):
        bases = _bases(seed)
        ordered = stored_turns(turns, seed)
        products = stored(running_products(ordered, bases))
        prefixes = stored(rebuilt_prefixes(products, bases, base, head, most_head))
        nodes = stored(prefixes.groupBy(*KEY).agg(
            F.min("c").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n").alias("deepest"), F.max("chars").alias("chars"), F.min("th").alias("least_th"), F.max("th").alias("most_th"),
            F.min(F.struct("ref", "place")).alias("last"),
        ))
        if _equal(ordered, nodes):
            break
    else:
        raise RuntimeError("turn hashes collide for every seed")
    less = [((F.col(f"f{j}") + PRIMES[j] - F.pmod("least_th", F.lit(PRIMES[j])) * _power(bases[j], F.col("d"), PRIMES[j]) % PRIMES[j]) % PRIMES[j]).alias(f"g{j}") for j in ks]
    # Names are put right in a second step: inside an expression with a lambda, a name is taken for a new column of the same select.
    up = nodes.where("d > 0").select(F.col("conv_id").alias("member"), F.col("d").alias("own"), *less)
    up = up.select("member", (F.col("own") - 1).alias("d"), *(F.col(f"g{j}").alias(f"f{j}") for j in ks))
    children = up.groupBy(*KEY).agg(F.count("*").alias("n_children"))
    parents = up.join(nodes.select(*KEY, F.col("conv_id").alias("parent_conv_id")), KEY).select(F.col("member").alias("conv_id"), (F.col("d") + 1).alias("d"), "parent_conv_id")
    full = nodes.join(_sums(prefixes, nodes), KEY).join(children, KEY, "left").join(_ends(prefixes), KEY, "left")
    # A conversation is the smallest of one node of a depth at most, so these two name a node.
    return full.join(parents, ["conv_id", "d"], "left").select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), F.col("last.ref").alias("ref_conv"), F.col("last.place").alias("ref_turn"),
    )

