"""The trie of conversation prefixes against one made of whole rebuilt texts."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helioflow.llm import prefix_trie
from helioflow.llm.common import read

BASE, HEAD = (lambda c: c - c % 100), (lambda c: F.crc32(c.cast("string")) % 6)


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode(), role or "", text or ""))
    own = {c: [x[4:] for x in sorted(turns)] for c, turns in own.items()}
    rebuilt, members = {}, defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        b = c - int(abs(c) % 100 * (1 if c >= 0 else -1))
        rebuilt[c] = own.get(b, [])[:h] + own[c][h:]
        for k in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:k])].append(c)
    kids, leaves, saved, out = defaultdict(list), {}, {}, []
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = sum(saved[k] for k in kids[node]) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    for node, ids in members.items():
        ends = ",".join(map(str, sorted(c for c in ids if len(rebuilt[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(ids), len(node), parent, len(ids), len(kids[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def key(r):
    return r[:2]


ODD = (
    [(5000, t, "user", f"common {t}") for t in range(7)]
    + [(c, t, "user", f"common {t}") for c in range(5001, 5040) for t in range(7)]  # copies of whole conversations
    + [(c, t, "user" if t % 2 else None, f"own {c} {t}" if t > 3 else "😀 é") for c in range(5040, 5060) for t in range(6)]
    + [(6001, 0, "user", "a"), (6002, 0, "user", "b"), (6017, 1, "user", "short")]  # their base is absent: some are turnless
    + [(7000, None, "user", "null first"), (7000, None, "user", "null second"), (7000, 0, None, None), (7000, 0, None, None), (7000, 0, "", "")]
    + [(7001, 3, "user", ""), (None, 0, "user", "no id"), (-5, 0, "user", "negative"), (-105, 2, "user", "negative"), (0, -1, "system", "earlier than the first")]
    + [(2**60 + 1, t, "user", "x" * 50) for t in range(300)]
)


@pytest.fixture(scope="module")
def turns(spark, sf_dir):
    odd = spark.createDataFrame(ODD, "conv_id long, turn long, role string, text string")
    extra = {c: F.lit(c) for c in ("c", "d", "f0", "th", "n", "at", "part", "owner")}
    return read(spark, sf_dir, "conversations").select(*odd.columns).unionByName(odd).withColumns(extra).repartition(5).cache()


def test_trie(turns, monkeypatch):
    """Also with id ranges of a few, so that the hash of ends goes over several."""
    wanted = sorted(plain_trie([tuple(r)[:4] for r in turns.collect()]), key=key)
    for ends in (prefix_trie.ENDS, 4):
        monkeypatch.setattr(prefix_trie, "ENDS", ends)
        found = prefix_trie.prefix_trie(turns, BASE, HEAD, 5)
        assert sorted((tuple(r)[:8] for r in found.collect()), key=key) == wanted


def test_last_turns_are_where_nodes_say(turns):
    own = defaultdict(list)
    for c, turn, role, text in (tuple(r)[:4] for r in turns.where("conv_id is not null").collect()):
        own[c].append((turn is not None, turn or 0, role or "", text or ""))
    nodes = prefix_trie.prefix_trie(turns, BASE, HEAD, 5).where("conv_id between 5000 and 5039 and depth > 0").collect()
    for r in nodes:
        assert sorted(own[r["ref_conv"]])[r["ref_turn"] - 1][3] == f"common {r['depth'] - 1}"
    assert nodes


def test_colliding_hashes_are_found(spark, turns, monkeypatch):
    """With fingerprints of a few values groups would mix; the check takes other bases until none does, and gives up after all."""
    few = spark.createDataFrame([(c, t, "user", f"{c} {t}") for c in range(100, 130) for t in range(4)], "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(prefix_trie, "PRIMES", (7, 7, 7))
    with pytest.raises(RuntimeError):
        prefix_trie.prefix_trie(few, BASE, HEAD, 5)


def test_long_conversation_over_many_ranges(spark):
    """One conversation with most turns: its running products are composed over the ranges it is dealt to."""
    rows = [(3, t, "user", f"t{t % 11}") for t in range(3000)] + [(4, t, "user", f"t{t % 11}") for t in range(40)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(9)
    none = prefix_trie.prefix_trie(turns, lambda c: c, lambda c: c * 0, 0)
    found = {(r["conv_id"], r["depth"]): r for r in none.collect()}
    assert len(found) == 3001 and found[3, 40]["n_convs"] == 2 and found[3, 41]["n_convs"] == 1 and found[3, 3000]["n_leaves"] == 1
    assert found[3, 0]["saved_tokens"] == sum(len(f"t{t % 11}") for t in range(40))


def test_no_turns(turns):
    assert prefix_trie.prefix_trie(turns.limit(0), BASE, HEAD, 5).count() == 0
