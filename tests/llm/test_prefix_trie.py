"""The prefix trie against a dictionary of prefixes, with every block size, and against its SQL."""

import hashlib
import random
import zlib

import duckdb
import pytest

from gondola.llm import oracles, prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, depth string, digest string, step string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    convs = {}
    for c, _, role, text in sorted(((c, (t is not None, t or 0), r or "", x or "") for c, t, r, x in rows if c is not None)):
        convs.setdefault(c, []).append((role, text))
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(convs.get(c - c % 100, [])[:h] + own[h:])
    nodes = {}
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            nodes.setdefault(rebuilt[c][:d], []).append(c)
    children, leaves, saved = ({k: 0 for k in nodes} for _ in range(3))
    for k in nodes:
        if k:
            children[k[:-1]] += 1
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(members) - 1) * len(k[-1][1]) if k else 0
    ends = {k: ",".join(str(c) for c in m if rebuilt[c] == k) for k, m in nodes.items()}
    return sorted(((m[0], len(k), nodes[k[:-1]][0] if k else None, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends[k].encode()).hexdigest()) for k, m in nodes.items()), key=repr)


def collect(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def frame(spark, rows):
    """Extra columns have the names that the operator uses itself."""
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)


def some_rows():
    r, rows = random.Random(5), []
    for c in [*range(40), 100, 117, 250, 251, 1034, 5000]:  # 250's hundred has no first conversation
        copied = c % 3 == 0
        for t in range(r.choice([1, 2, 5, 7, 9])):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"copied {t}" if copied or t < 2 else f"own {c} {t} é"))
    rows += [(3, None, "user", "before"), (4, None, None, None), (4, None, None, None), (5, 0, None, "same turn"), (5, 0, "a", None), (None, 0, "user", "of none"), (6, 99, "user", "x" * 300_000), (7, 50, "user", "twice"), (7, 50, "user", "twice")]
    for c in (8, 9):  # the same long conversation twice, and a longer one
        rows += [(c, 1000 + t, "user", f"long {t}") for t in range(150)]
    return rows + [(9, 5000 + t, "user", "tail") for t in range(60)]


@pytest.mark.parametrize("block", [2, 5, 64])
def test_every_block_size_gives_the_same_nodes(spark, block):
    rows = some_rows()
    turns, convs = prefix_trie.with_borrowed_turns(prefix_trie.turns_in_order(frame(spark, rows)))
    assert collect(prefix_trie.trie(turns, convs, block)) == brute(rows)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_tables(spark, sf):
    path = f"/root/testdata/{sf}"
    got = collect(queries.queries()["op11_prefix_trie"](spark, path))
    duck = duckdb.connect()
    duck.execute(f"create view conversations as from '{path}/conversations.parquet'")
    assert got == brute(duck.sql("select conv_id, turn, role, text from conversations").fetchall())
    assert got == sorted(duck.sql(f"select {', '.join(COLUMNS)} from ({oracles.TRIE})").fetchall(), key=repr)


def test_a_conversation_that_is_often_copied(spark):
    """A third of all conversations are one; its list of members is hashed in pieces."""
    rows = [(c, t, "user", f"hot {t}") for c in range(0, 9000, 3) for t in range(3)] + [(c, 0, "user", f"cold {c}") for c in range(1, 9000, 3)]
    assert collect(prefix_trie.shared_prefixes(frame(spark, rows))) == brute(rows)


def test_negative_ids_and_one_turn(spark):
    rows = [(-250, 0, "user", "a"), (-201, 0, "user", "b"), (-3, 1, "user", "c"), (0, 0, "user", "z")]
    convs = sorted(r[0] for r in collect(prefix_trie.shared_prefixes(frame(spark, rows))) if r[1] == 0)
    assert convs == [-250]


def test_empty_table(spark):
    assert collect(prefix_trie.shared_prefixes(frame(spark, []))) == []
    assert collect(prefix_trie.shared_prefixes(frame(spark, [(None, 0, "user", "of none")]))) == []
