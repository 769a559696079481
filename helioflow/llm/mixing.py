"""Language-model scoring by online logistic context mixing.

A text is read word by word, in order, and each word bit by bit. The corpus's most frequent words, and
an escape for all others, have prefix codes: the path down a binary tree. At each node several
predictors tell the next bit:

* the corpus: how often its words went either way at this node;
* the text so far: how often it went either way here, with the corpus weighing as much as a few, and
  as many, earlier words;
* hashed contexts: the word that followed the last time the text had the same word, or the same two
  words, before, as long as its path is the one taken so far.

A mixer combines the predictions, as log odds, with weights of the set that a gate picks by how
far down the node is and how well the two contexts have foretold so far. Every text starts with the same
weights; after each ``BLOCK`` words they are moved by the gradient of what the text cost.

After an escape one more bit, predicted from how often it was so before in the text, tells whether the
word has been in the text already; then it is one of the text's earlier such words, as often
as they occurred. Else it has its share of the corpus's other words, where absolute discounting
leaves a part for words never seen, spelt byte by byte: hashed contexts of the last 0 to 5 bytes predict the bits,
counted over the whole vocabulary and mixed by weights learnt online in blocks, one for each task,
and averaged.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioflow.llm.common import held_out, slices, stored

ORDERS = 6
#: Slots of each byte context's table; a bound on what the model holds.
SLOTS = 1 << 18
#: Words with a code of their own, the most frequent ones, go to every task; the others are joined.
HEAD_WORDS = 200_000
END = b""  # no word is empty: this stands for a text's end
#: Step sizes of the gradient, for spelling and for texts.
RATE, TEXT_RATE = 0.02, 0.015
#: Characters of text that a worker scores at a time: small arrays stay in the cache.
PART = 150_000
#: Words of a text after which its weights are moved.
BLOCK = 64
#: So many earlier words does the corpus weigh as much as, in the two predictions from the text so far.
PRIORS = (2.0, 30.0)
#: Weights that every text starts with: of the corpus, the two predictions from the text, and, for each
#: state, of the last word's and the last two words' context.
START, START_1, START_2 = (0.2, 0.3, 0.5), (0.0, 0.3, 0.9, 1.6), (0.0, 1.0, 2.5, 4.0)
#: States of a context: new, or met with so many right foretellings in a row, the last for all above.
STATES, DEPTHS = 4, 4
#: How often a word counts at most in what the speller learns.
DAMPED = 2
#: About so many words teach the speller's mixer in a row; the weights of all such blocks are averaged.
LEARNT_TOGETHER = 50_000


def tokens(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased, then the end."""
    return [*(text or "").encode("utf-8", "replace").lower().split(), END]


def bit_contexts(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bits of words, each closed by a zero byte: (slots, orders x bits; bits; gate; owner)."""
    data = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
    sizes = np.array([len(w) + 1 for w in words])
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    past = np.zeros(len(data), np.uint64)
    hashes = []
    for k in range(ORDERS):
        if k:
            before = np.zeros(len(data), np.uint64)
            before[k:] = data[:-k]
            before[place < k] = 0
            past = (past + before + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        hashes.append(past + np.uint64(k) if k != 1 else past + np.minimum(place, 7).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    eight = np.arange(8, dtype=np.uint8)
    nodes = (1 << eight) | (data[:, None] >> (8 - eight.astype(np.int16))).astype(np.uint8)  # the bits of the byte so far, after a 1
    bits = (data[:, None] >> (7 - eight)) & 1
    spread = nodes.astype(np.uint32) * np.uint32(0x9E3779B1)
    slots = np.empty((ORDERS, len(data) * 8), np.int64)
    for k, h in enumerate(hashes):
        short = ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.uint32)
        slots[k] = ((short[:, None] ^ spread) * np.uint32(0x85EBCA77) >> np.uint32(33 - SLOTS.bit_length())).ravel()
    gate = np.minimum(place, 3)[:, None] * 8 + eight
    return slots, bits.ravel(), gate.ravel(), np.repeat(owner, 8)


@dataclass
class Codes:
    """Prefix codes of the head words and, last, the escape. ``bits``: from the top of 48 bits;
    ``length``; ``first``: where in ``nodes`` and ``turns`` the path begins; ``odds``: of each node,
    the corpus's log odds of a one."""

    bits: np.ndarray
    length: np.ndarray
    first: np.ndarray
    nodes: np.ndarray
    turns: np.ndarray
    odds: np.ndarray


CODE_BITS = 48


def prefix_codes(counts: np.ndarray) -> Codes:
    """Huffman's codes for counts, the rarest word first; counts are raised where codes would get too long."""
    weight = np.maximum(np.asarray(counts, np.float64), max(1.0, counts.sum() / 2**30))
    leaves = len(weight)
    order = np.argsort(weight, kind="stable")
    total = np.concatenate([weight, np.zeros(leaves - 1)])
    parent, turn = np.full(2 * leaves - 1, -1), np.zeros(2 * leaves - 1, np.uint8)
    value, queue, leaf, inner = total.tolist(), order.tolist(), 0, leaves
    for node in range(leaves, 2 * leaves - 1):
        for side in (0, 1):
            if leaf < leaves and (inner >= node or value[queue[leaf]] <= value[inner]):
                child, leaf = queue[leaf], leaf + 1
            else:
                child, inner = inner, inner + 1
            parent[child], turn[child] = node, side
            value[node] += value[child]
    total = np.array(value)
    ones = np.zeros(2 * leaves - 1)
    up = np.flatnonzero(parent >= 0)
    ones[parent[up[turn[up] == 1]]] = total[up[turn[up] == 1]]
    share = ones[leaves:] / total[leaves:]
    length = np.zeros(2 * leaves - 1, np.int64)
    for node in range(2 * leaves - 3, -1, -1):
        length[node] = length[parent[node]] + 1
    length = length[:leaves]
    first = np.cumsum(length) - length
    nodes, turns = np.zeros(length.sum(), np.int32), np.zeros(length.sum(), np.uint8)
    bits, at, place = np.zeros(leaves, np.uint64), np.arange(leaves), length - 1
    own = np.flatnonzero(place >= 0)
    while len(own):
        nodes[first[own] + place[own]] = parent[at[own]] - leaves
        turns[first[own] + place[own]] = turn[at[own]]
        bits[own] |= turn[at[own]].astype(np.uint64) << (CODE_BITS - 1 - place[own]).astype(np.uint64)
        at[own], place[own] = parent[at[own]], place[own] - 1
        own = own[place[own] >= 0]
    return Codes(bits, length, first, nodes, turns, np.log(share / (1 - share)).astype(np.float32))


def _chains(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places sorted by key, then order; and where in them a key begins. Keys leave room for a place."""
    room = np.uint64(max(1, int(len(key)).bit_length()))
    both = np.sort(key.astype(np.uint64) << room | np.arange(len(key), dtype=np.uint64))
    new = np.ones(len(key), bool)
    new[1:] = (both[1:] >> room) != (both[:-1] >> room)
    return (both & ((np.uint64(1) << room) - np.uint64(1))).astype(np.int64), new


def _foretold(context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word: the word that came after the last equal context (-1: none), and the context's state."""
    said, state = np.full(len(word), -1), np.zeros(len(word), np.int64)
    if not len(word):
        return said, state
    at, new = _chains(context)
    own, before = at[1:], at[:-1]
    right = np.concatenate([[False], ~new[1:] & (word[own] == word[before])])
    places = np.arange(len(at))
    wrong = np.maximum.accumulate(np.where(right, 0, places))
    row = np.concatenate([[0], (places - wrong)[:-1]])  # right foretellings in a row, this one left out
    met = ~new
    said[at[met]] = word[at[np.flatnonzero(met) - 1]]
    state[at[met]] = 1 + np.minimum(row[met], STATES - 2)
    return said, state


def _mix(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    h = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(31)) ^ c.astype(np.uint64)) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(29))) >> np.uint64(26)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading bits two codes share."""
    return CODE_BITS - np.frexp((a ^ b).astype(np.float64))[1]


def code_costs(codes: Codes, word: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Natural log probability of each text's codes, all bits in order. ``word``: numbers of the words,
    head words first, other words from the escape's number on; ``doc``: rising numbers of the texts."""
    n = len(word)
    out = np.zeros(docs)
    if not n:
        return out
    begins = np.searchsorted(doc, np.arange(docs))
    place = np.arange(n) - begins[doc]
    last = np.where(place > 0, np.roll(word, 1), -1)
    before = np.where(place > 1, np.roll(word, 2), -1)
    # From here on in blocks: the first of each text, the second of each, and so on.
    block = place // BLOCK
    order = np.argsort(block, kind="stable")
    word, doc, last, before, block = word[order], doc[order].astype(np.int32), last[order], before[order], block[order]
    escape = len(codes.length) - 1
    code = np.minimum(word, escape)
    length = codes.length[code]
    ends = np.cumsum(length)
    token = np.repeat(np.arange(n, dtype=np.int32), length)
    at = np.arange(ends[-1])
    depth = (at - np.repeat(ends - length, length)).astype(np.int8)
    at += np.repeat(codes.first[code] - ends + length, length)
    node, one = codes.nodes[at], codes.turns[at]
    sign = one.astype(np.float32) * 2 - 1
    whose = doc[token]

    gate = np.minimum(depth >> 2, DEPTHS - 1)
    odds = codes.odds[node]
    inputs = [odds * sign]
    at, new = _chains(whose * np.int64(len(codes.odds)) + node)
    so_far = np.arange(len(at), dtype=np.int32)
    start = np.maximum.accumulate(np.where(new, so_far, 0))
    sorted_one = one[at]
    ones = np.cumsum(sorted_one, dtype=np.int32) - sorted_one
    seen, seen_one = np.empty(len(at), np.float32), np.empty(len(at), np.float32)
    seen[at], seen_one[at] = so_far - start, ones - ones[start]
    p = 1 / (1 + np.exp(-odds))
    for k in map(np.float32, PRIORS):
        inputs.append(np.log((seen_one + k * p) / (seen - seen_one + k * (1 - p))) * sign)
    for context, step in ((_mix(doc, last, np.zeros(n, np.int64)), DEPTHS), (_mix(doc, last, before + 2), DEPTHS * STATES)):
        said, state = _foretold(context, word)
        said = np.minimum(said, escape)
        shared = np.where(said >= 0, _common(codes.bits[said], codes.bits[code]), -1).astype(np.int8)
        shared[said == code] = CODE_BITS
        behind = shared[token] - depth
        with_path = behind >= 0
        inputs.append((with_path.view(np.int8) - 2 * (behind == 0).view(np.int8)).astype(np.float32))
        gate += with_path.view(np.int8) * (state * step).astype(np.int8)[token]

    sets = DEPTHS * STATES * STATES
    states = np.arange(sets) // DEPTHS
    first = [np.full(sets, x) for x in START] + [np.array(START_1)[states % STATES], np.array(START_2)[states // STATES]]
    weights = [np.tile(w, docs).astype(np.float32) for w in first]
    which = whose * np.int64(sets) + gate
    cost = np.empty(len(which), np.float32)
    edges = np.append(np.searchsorted(block, np.arange(block[-1] + 1)), n)
    edges = np.concatenate([[0], ends])[edges]
    for a, b in zip(edges, edges[1:], strict=False):
        own = which[a:b]
        x = [i[a:b] for i in inputs]
        odds_of_wrong = np.exp(-sum(w[own] * i for w, i in zip(weights, x, strict=True)))
        either = 1 + odds_of_wrong
        cost[a:b] = np.log(either)
        error = np.float32(TEXT_RATE) * odds_of_wrong / either
        for w, i in zip(weights, x, strict=True):
            if b - a > 2 * len(w):
                w += np.bincount(own, error * i, len(w)).astype(np.float32)
            else:
                np.add.at(w, own, error * i)
    return -np.bincount(whose, cost, docs)


def repeat_costs(word: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Natural log probability of what follows the escapes of each text, in order, but for the words
    that are new to it: whether each one is new, and if not, which of the earlier ones it is."""
    if not len(word):
        return np.zeros(docs)
    place = np.arange(len(word)) - np.searchsorted(doc, np.arange(docs))[doc]
    at, new = _chains(_mix(doc, word, np.zeros(len(word), np.int64)))
    rank = np.arange(len(at))
    times = np.empty(len(at), np.int64)
    times[at] = rank - np.maximum.accumulate(np.where(new, rank, 0))
    again = times > 0
    before = np.cumsum(again) - again
    before = before - before[np.searchsorted(doc, np.arange(docs))[doc].clip(max=len(word) - 1)]
    # The first of a text can't be a repeat: no bit tells.
    chance = (before + 0.2) / (place + 2.0)
    cost = np.where(again, np.log(chance) + np.log(np.maximum(times, 1) / np.maximum(place, 1)), np.where(place > 0, np.log(1 - chance), 0.0))
    return np.bincount(doc, cost, docs)


@dataclass
class Speller:
    """``stretch`` and ``trust``: each slot's stretched prediction, and the same weighed by its
    confidence, orders x slots; ``weights``: gates x (orders x 2 + 1)."""

    stretch: np.ndarray
    trust: np.ndarray
    weights: np.ndarray

    def chances(self, words: list[bytes]) -> np.ndarray:
        """Natural log probability of each word's spelling, its end included."""
        out = np.zeros(len(words))
        for at in range(0, len(words), 5_000):
            part = words[at : at + 5_000]
            slots, bits, gate, owner = bit_contexts(part)
            z = self.weights[:, -1][gate]
            for k in range(ORDERS):
                z += self.stretch[k][slots[k]] * self.weights[:, 2 * k][gate] + self.trust[k][slots[k]] * self.weights[:, 2 * k + 1][gate]
            z[bits > 0] *= -1
            out[at : at + len(part)] = np.bincount(owner, -np.log1p(np.exp(np.minimum(z, 600))), len(part))
        return out


def stretched(zero: np.ndarray, one: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of counts, and the same shrunk where the counts are few."""
    odds = np.log((one + np.float32(0.2)) / (zero + np.float32(0.2)))
    both = zero + one
    return odds, odds * (both / (both + np.float32(20)))


def learn_mixer(zeros: np.ndarray, ones: np.ndarray, words: list[bytes], counts: np.ndarray) -> np.ndarray:
    """Weights by online gradient steps, 64 words at a time, each word without its own counts."""
    weights = np.zeros((2 * ORDERS + 1, 32), np.float32)
    weights[1 : 2 * ORDERS : 2] = 0.3
    for at in range(0, len(words), 64):
        slots, bits, gate, owner = bit_contexts(words[at : at + 64])
        own = counts[at : at + 64].astype(np.float32)[owner]
        own_one = own * bits.astype(np.float32)
        own_zero = own - own_one
        x = []
        for k in range(ORDERS):
            x += stretched(np.maximum(zeros[k][slots[k]] - own_zero, 0), np.maximum(ones[k][slots[k]] - own_one, 0))
        x.append(np.ones(len(bits), np.float32))
        z = sum(w[gate] * i for w, i in zip(weights, x, strict=True))
        error = bits.astype(np.float32) - 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        for w, i in zip(weights, x, strict=True):
            w += (RATE / 8) * np.bincount(gate, np.clip(error * i, -4, 4), 32)
    return weights.T


@dataclass
class Corpus:
    """What scoring needs: totals of all and of the other words, the speller, the head words'
    numbers, counts and codes."""

    total: int
    distinct: int
    discount: float
    other_total: int
    other_distinct: int
    speller: Speller
    head: dict[bytes, int]
    counts: np.ndarray
    codes: Codes

    def base(self, n: np.ndarray, count: np.ndarray) -> np.ndarray:
        return n * np.log10((count + 1) / (self.total + self.distinct + 1))

    def new_word(self, count: np.ndarray, spelt: np.ndarray) -> np.ndarray:
        """Natural log probability of a word new to a text, after an escape."""
        unseen = self.discount * self.other_distinct + 1
        return np.log((np.maximum(count - self.discount, 0) + unseen * np.exp(np.maximum(spelt, -600))) / (self.other_total + 1))


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    found: Counter[bytes] = Counter()
    for rows in slices(frames, "text", 2_000_000):
        for text in rows["text"]:
            found.update(tokens(text if isinstance(text, str) else None))
        if len(found) > 600_000:
            yield pd.DataFrame({"word": list(found), "n": list(found.values())})
            found.clear()
    yield pd.DataFrame({"word": list(found), "n": list(found.values())})


def vocabulary(train: DataFrame) -> DataFrame:
    """``word, n``: how often each token occurs in all training texts; stored."""
    counts = train.select("text").mapInPandas(_counted, "word binary, n long")
    return stored(counts.groupBy("word").agg(F.sum("n").alias("n")))


def fit(words: DataFrame) -> Corpus:
    """The model from a stored vocabulary. The driver gets bounded tables only."""
    spark = words.sparkSession
    totals = words.agg(F.sum("n"), F.count("*"), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    # The usual estimate from the words seen once and twice.
    discount = min(0.9, max(0.3, totals[2] / max(1, totals[2] + 2 * totals[3])))

    def bit_counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, ORDERS, SLOTS))
        for frame in frames:
            own = frame[frame["word"].str.len() > 0]
            for at in range(0, len(own), 20_000):
                part = own.iloc[at : at + 20_000]
                slots, bits, _, owner = bit_contexts(part["word"].tolist())
                weight = part["n"].to_numpy(np.float64)[owner]
                for k in range(ORDERS):
                    sums[0, k] += np.bincount(slots[k], weight * (1 - bits), SLOTS)
                    sums[1, k] += np.bincount(slots[k], weight * bits, SLOTS)
        used = np.flatnonzero(sums.sum(0).ravel())
        flat = sums.reshape(2, -1)[:, used].astype(np.int32)
        yield pd.DataFrame({"slot": used, "zero": flat[0], "one": flat[1]})

    # A word's count is damped, so that what is learnt is how words are spelt, not a few frequent ones.
    damped = words.select("word", F.least("n", F.lit(DAMPED)).alias("n"))
    sums = [F.sum(c).cast("int").alias(c) for c in ("zero", "one")]
    slots = damped.mapInPandas(bit_counts, "slot int, zero int, one int").groupBy("slot").agg(*sums).toArrow()
    tables = np.zeros((2, ORDERS * SLOTS), np.float32)
    tables[0, slots["slot"].to_numpy()], tables[1, slots["slot"].to_numpy()] = slots["zero"].to_numpy(), slots["one"].to_numpy()
    tables = tables.reshape(2, ORDERS, SLOTS)
    counted = spark.sparkContext.broadcast(tables)

    def taught(rows: pd.DataFrame) -> pd.DataFrame:
        """Weights that a block's words teach one after the other, with the number of words."""
        own = rows.sort_values(["order", "word"])
        weights = learn_mixer(*counted.value, own["word"].map(bytes).tolist(), own["n"].to_numpy(np.float64))
        return pd.DataFrame({"place": np.arange(weights.size), "weight": weights.ravel() * len(own), "n": len(own)})

    # Blocks and their order come from the words' hashes, so that neither partitions nor batches change what is learnt.
    blocks = max(1, -(-int(totals[1]) // LEARNT_TOGETHER))
    placed = damped.where(F.octet_length("word") > 0).select("*", F.xxhash64("word", F.lit(1)).alias("order"))
    each = placed.withColumn("block", F.pmod(F.xxhash64("word", F.lit(2)), F.lit(blocks))).groupBy("block").applyInPandas(taught, "place int, weight double, n long")
    mean = each.groupBy("place").agg((F.sum("weight") / F.sum("n")).alias("weight")).toPandas()
    weights = np.zeros(32 * (2 * ORDERS + 1))
    weights[mean["place"]] = mean["weight"]
    odds = [stretched(tables[0, k], tables[1, k]) for k in range(ORDERS)]
    speller = Speller(np.array([o[0] for o in odds], np.float32), np.array([o[1] for o in odds], np.float32), weights.reshape(32, -1))
    # The least count at which the words from there on are HEAD_WORDS at most, on a scale of at most a few hundred steps.
    scale = words.groupBy(F.floor(F.log2("n") * 8).alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("least")).toPandas()
    scale = scale.sort_values("step", ascending=False)
    fits = scale[scale["words"].cumsum() <= HEAD_WORDS]
    least = int(fits["least"].min()) if len(fits) else None
    top = words.where(F.col("n") >= least if least else F.lit(False)).orderBy(F.desc("n"), "word").toArrow()
    names, counts = top["word"].to_pylist(), top["n"].to_numpy().astype(np.int64)
    others = int(totals[0] or 0) - int(counts.sum()), int(totals[1]) - len(names)
    # What the escape weighs: the other words, and as many unseen ones as there are head words seen once.
    codes = prefix_codes(np.append(counts, others[0] + 1 + (counts == 1).sum()))
    return Corpus(int(totals[0] or 0), int(totals[1]), discount, *others, speller, {w: k for k, w in enumerate(names)}, counts, codes)


def scores(docs: DataFrame, modulus: int = 7) -> DataFrame:
    """Score every whole text of ``docs``, learning from those that aren't held out.

    Returns for every row ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte``; scores are log10 probabilities. Null and empty texts are one token, the end,
    and have no bits per byte. Repeated rows and null ids keep their rows; a null id is never held
    out. If all rows are held out, nothing is known and the speller alone scores. Empty input: no
    rows. Other columns are not read.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn(
        "held_out", held_out("doc_id", modulus)
    )
    words = vocabulary(plain.where(~F.col("held_out")))
    corpus = fit(words)
    shared = docs.sparkSession.sparkContext.broadcast(corpus)
    sums = ["base", "known", "cost"]

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A row for each document with what is known here, and one for each distinct other word."""
        model = shared.value
        escape = len(model.head)
        serial = TaskContext.get().partitionId() << 40
        for rows in slices(frames, "text", PART):
            texts = [tokens(t if isinstance(t, str) else None) for t in rows["text"]]
            sizes = np.array([len(t) for t in texts])
            flat = [w for t in texts for w in t]
            word = np.fromiter(map(model.head.get, flat, repeat(-1)), np.int64, len(flat))
            doc = np.repeat(np.arange(len(rows)), sizes)
            inside = word >= 0
            count = model.counts[word[inside]]
            own: dict[bytes, int] = {}
            word[~inside] = [own.setdefault(flat[i], escape + len(own)) for i in np.flatnonzero(~inside)]
            keys = serial + np.arange(len(rows))
            serial += len(rows)
            one = np.ones(inside.sum())
            cost = code_costs(model.codes, word, doc, len(rows)) + repeat_costs(word[~inside], doc[~inside], len(rows))
            frame = pd.DataFrame({"key": keys, "no_id": rows["no_id"].to_numpy(), "doc_id": rows["doc_id"].to_numpy(), "held_out": rows["held_out"].to_numpy()})
            frame["bytes"] = [len(t.encode("utf-8", "replace")) if isinstance(t, str) else 0 for t in rows["text"]]
            frame["n"] = sizes
            for name, term in zip(sums, (np.bincount(doc[inside], model.base(one, count), len(rows)), np.bincount(doc[inside], minlength=len(rows)).astype(float), cost), strict=True):
                frame[name] = term
            frame["word"] = None
            yield frame
            if own:
                pair, n = np.unique(doc[~inside] * np.int64(len(own)) + word[~inside] - escape, return_counts=True)
                spelling = list(own)
                tail = pd.DataFrame({"key": keys[pair // len(own)], "n": n, "word": [spelling[i] for i in pair % len(own)]})
                yield tail.reindex(columns=frame.columns).astype({"no_id": "boolean", "doc_id": "Int64", "bytes": "Int64", "held_out": "boolean"})

    columns = "key long, no_id boolean, doc_id long, held_out boolean, bytes long, n long, " + ", ".join(f"{s} double" for s in sums) + ", word binary"
    # Pandas would make floats of ids with nulls among them.
    marked = plain.select(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "held_out", "text")
    parts = stored(marked.mapInPandas(split, columns))

    def spelt(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            codes, distinct = pd.factorize(f["word"].map(bytes))
            spelling = shared.value.speller.chances(list(distinct))[codes] if len(f) else np.zeros(0)
            n, count = f["n"].to_numpy(np.float64), f["count"].to_numpy(np.float64)
            terms = shared.value.base(n, count), np.where(count > 0, n, 0), shared.value.new_word(count, spelling)
            yield pd.DataFrame({"key": f["key"], **dict(zip(sums, terms, strict=True))})

    tail = parts.where(F.col("word").isNotNull()).select("key", "n", "word")
    joined = tail.join(words.withColumnRenamed("n", "count"), "word", "left").select("key", "n", "word", F.coalesce("count", F.lit(0)).alias("count"))
    added = joined.mapInPandas(spelt, "key long, " + ", ".join(f"{s} double" for s in sums)).groupBy("key").agg(*(F.sum(s).alias(f"more_{s}") for s in sums))
    own = parts.where(F.col("word").isNull()).join(added, "key", "left")
    both = {s: F.col(s) + F.coalesce(f"more_{s}", F.lit(0.0)) for s in sums}
    return own.select(
        F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "held_out", F.col("n").alias("n_tokens"), both["known"].cast("long").alias("n_known"),
        F.lit(corpus.total).cast("long").alias("train_tokens"), both["base"].alias("base_score"), (both["cost"] / F.log(F.lit(10.0))).alias("score"),
        F.when(F.col("bytes") > 0, -both["cost"] / F.log(F.lit(2.0)) / F.col("bytes")).alias("bits_per_byte"),
    )
