import hashlib
import random
import zlib

import pytest

from tessera.llm.burst_trie import trie_nodes

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """All prefixes of all rebuilt conversations, as tuples."""
    turns = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            md5 = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns.setdefault(c, []).append((t is not None, t or 0, md5, role, text))
    turns = {c: [x[3:] for x in sorted(v)] for c, v in turns.items()}
    members = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        path = tuple(turns.get(base, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append((c, len(path) == d))
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(saved[k] for k in kids.get(p, []))
    out = []
    for p, m in members.items():
        done = ",".join(str(c) for c in sorted(c for c, e in m if e))
        out.append((min(m)[0], len(p), min(members[p[:-1]])[0] if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(done.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, **kw):
    return sorted((tuple(r) for r in trie_nodes(spark.createDataFrame(rows, SCHEMA), **kw).collect()), key=str)


def conversations(seed, n, most=12, words=3):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.randint(1, most)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"say é{r.randrange(words)}"))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("kw", [{}, {"limit": 10}, {"segment": 2, "limit": 4}])
def test_equals_brute_force(spark, kw):
    rows = conversations(1, 100) + conversations(2, 30, most=14, words=1)
    assert got(spark, rows, **kw) == brute(rows)


def test_one_conversation_with_a_third_of_all_turns(spark):
    rows = conversations(5, 60) + [(c, t, "user", f"{t % 7}") for c in (100, 101, 200, 300) for t in range(700)]
    want = brute(rows)
    assert got(spark, rows, segment=64, limit=100) == want
    assert got(spark, rows) == want


def test_many_equal_conversations(spark):
    rows = [(5 * c, t, "user", f"hello {t}") for c in range(300) for t in range(9)] + conversations(7, 20)
    assert got(spark, rows, limit=20) == brute(rows)


def test_edges(spark):
    assert got(spark, []) == []
    assert got(spark, [(None, 1, "user", "x")]) == []
    rows = [(3, None, None, None), (3, 0, "user", ""), (3, 0, "", "user"), (3, 0, "user", ""), (-4, 1, "a", "b"), (-1, 0, "a", "b"), (0, 5, "x", "y" * 100_000),
            (0, -5, None, "z"), (10, 2, "q", None), (12, 2, "q", ""), (14, 7, "q", "ü"), (None, 2, "q", "w")]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows, limit=0, segment=1) == brute(rows)
    df = spark.createDataFrame([(1, 0, "u", "a", 5, "k")], SCHEMA + ", pos int, x string")
    assert trie_nodes(df).count() >= 1


def test_query_on_whole_table(spark):
    import __spark_entry__ as entry
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = entry.queries()["op13_burst_trie"](spark, "/root/testdata/sf0.01")
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(rows)
