"""The prefix trie against a brute-force one."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from lakespark.llm import queries, trie

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def whole(rows):
    """conv_id: turns in order, from rows (conv_id, turn, role, text)."""
    out = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            out[c].append((t is not None, t or 0, digest(role or "", text or ""), role or "", text or ""))
    return {c: [x[3:] for x in sorted(turns)] for c, turns in out.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for key in members:
        if key:
            children[key[:-1]] += 1
    for key, found in members.items():
        value = (len(found) - 1) * len(key[-1][1].encode()) if key else 0
        for d in range(len(key) + 1):
            saved[key[:d]] += value
            leaves[key[:d]] += not children[key]
    ends = defaultdict(list)
    for c in sorted(convs):
        ends[tuple(convs[c])].append(str(c))
    return sorted(
        (m[0], len(k), members[k[:-1]][0] if k else None, len(m), children[k], leaves[k], saved[k], hashlib.sha256(",".join(ends[k]).encode()).hexdigest())
        for k, m in members.items()
    )


def built(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert df.columns == columns and all(t == "bigint" for c, t in df.dtypes[:-1])
    return sorted(tuple(r) for r in df.collect())


def plain(spark, rows):
    turns = trie.numbered(spark.createDataFrame(rows, SCHEMA))
    return built(trie.prefix_trie(turns, turns.select("conv_id")))


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert built(queries.QUERIES["op11_prefix_trie"](spark, sf)) == brute(rebuilt(whole(rows)))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_trees(spark, seed, monkeypatch):
    """Few distinct turns, so that conversations diverge everywhere; small stretches, so that all are crossed."""
    for name, bits in (("TURN_BITS", 2), ("CHAIN_BITS", 1), ("ID_BITS", 2)):
        monkeypatch.setattr(trie, name, bits)
    rng = random.Random(seed)
    rows = []
    for c in range(-20, 130):
        n = rng.choice((0, 1, 3, 4, 5, 8, 9, 13))
        rows += [(c, t, rng.choice(("user", "assistant")) if rng.random() < 0.2 else "user", rng.choice("ab" if t % 3 else "ä")) for t in range(n)]
    rng.shuffle(rows)
    convs = whole(rows)
    assert plain(spark, rows) == brute(convs)
    turns = trie.numbered(spark.createDataFrame(rows, SCHEMA))
    assert built(trie.prefix_trie(trie.share_openings(turns), turns.select("conv_id"))) == brute(rebuilt(convs))


def test_ladder(spark):
    """Each conversation leaves the one before a turn later: the tree of chains is as high as it can be."""
    rows = [(c, t, "user", "x" if t < c else f"end {c}") for c in range(20) for t in range(c + 1)]
    assert plain(spark, rows) == brute(whole(rows))


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 0, "user", "tie b"), (1, 0, "user", "tie a"), (1, 0, "user", "tie a"),
        (2, 5, "user", "first"), (2, 9, "", ""), (3, 1, "user", "x" * 300_000), (None, 1, "user", "nobody's"), (4, -3, "us", "erfirst"), (4, 2**40, "user", "far"),
        (5, 0, "user", "first"), (5, 1, "user", ""),
    ]
    assert plain(spark, rows) == brute(whole(rows))


def test_without_turns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    turns = trie.numbered(empty)
    assert built(trie.prefix_trie(turns, turns.select("conv_id"))) == []
    ids = spark.createDataFrame([(3,), (None,), (7,), (3,)], "conv_id long")
    assert built(trie.prefix_trie(turns, ids)) == brute({3: [], 7: []})


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (2, 0, "user", "a")], SCHEMA).selectExpr("*", "1 as depth", "'z' as digest", "5 as position", "0 as block", "9 as c")
    turns = trie.numbered(df)
    assert built(trie.prefix_trie(turns, turns.select("conv_id"))) == brute({1: [("user", "a")], 2: [("user", "a")]})
