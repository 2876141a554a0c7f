import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadflow.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = [(c, t, "user" if t % 2 == 0 else "assistant", f"t{c % 3}-{t}" if t < 4 else f"own {c} {t}") for c in range(40) for t in range(c % 9)]
ROWS += [(150 + i, t, "user", "same" * (t + 1)) for i in range(20) for t in range(12)]
#: Null turns, roles and texts, a repeated row, a long conversation, a base without rows (c - c % 100 = 200), a negative id, no id.
ROWS += [(100, None, "user", None), (100, 2, None, "x"), (100, 2, None, "x"), (207, 0, "user", "only"), (299, 0, "u", "\U0001f600é")]
ROWS += [(300, t, "user", f"long {t}") for t in range(700)] + [(301, t, "a", "b") for t in range(3)] + [(-7, 0, "user", "minus"), (None, 0, "user", "nobody")]


def plain(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = own.get(c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100)), [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            nodes.setdefault(tuple(whole[:d]), []).append((c, len(whole) == d))
    out = {}
    children, leaves, saved = {}, {}, {}
    for key in nodes:
        if key:
            children[key[:-1]] = children.get(key[:-1], 0) + 1
    for key, members in nodes.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] = leaves.get(key[:d], 0) + (key not in children)
            saved[key[:d]] = saved.get(key[:d], 0) + (len(members) - 1) * (len(key[-1][1]) if key else 0)
    for key, members in nodes.items():
        ids = ",".join(str(c) for c, end in sorted(members) if end)
        parent = min(nodes[key[:-1]])[0] if key else None
        row = (min(members)[0], len(key), parent, len(members), children.get(key, 0), leaves[key], saved[key], hashlib.sha256(ids.encode()).hexdigest())
        out[row] = out.get(row, 0) + 1
    return out


def counted(df):
    out = {}
    for r in df.collect():
        row = (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
        out[row] = out.get(row, 0) + 1
    return out


@pytest.mark.parametrize("local", [40, 1_000_000])
def test_equals_brute_force(shipped, local):
    """The same rows whether components are cut by jobs or inside a task."""
    df = shipped.createDataFrame(ROWS, SCHEMA).selectExpr("*", "1 as node", "'x' as weight", "2 as comp", "3 as pos")
    assert counted(trie.prefix_trie(trie.opened_conversations(df), local)) == plain(ROWS)


def test_hot_parent_and_id_blocks(shipped, monkeypatch):
    monkeypatch.setattr(trie, "HOT_CHILDREN", 2)
    monkeypatch.setattr(trie, "ID_BLOCK", 4)
    df = shipped.createDataFrame(ROWS, SCHEMA)
    assert counted(trie.prefix_trie(trie.opened_conversations(df))) == plain(ROWS)


def test_empty_and_turnless(shipped):
    df = shipped.createDataFrame(ROWS, SCHEMA)
    assert trie.prefix_trie(trie.opened_conversations(df.limit(0))).count() == 0
    alone = [(207, 0, "user", "only")]
    assert zlib.crc32(b"207") % 6 > 0
    assert counted(trie.prefix_trie(trie.opened_conversations(shipped.createDataFrame(alone, SCHEMA)))) == plain(alone)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(1, 5), st.integers(-9, 9)), min_size=1, max_size=60))
def test_split_sums(rows):
    parent = [-1 if i == 0 or p % 11 == 0 else p % i for i, (p, _, _) in enumerate(rows)]
    weight, want = [w for _, w, _ in rows], [v for _, _, v in rows]
    for i in reversed(range(len(rows))):
        if parent[i] >= 0:
            weight[parent[i]] += weight[i]
            want[parent[i]] += want[i]
    assert trie.split_sums(parent, weight, [[v for _, _, v in rows]]) == [want]


def test_long_chain_is_cut_in_few_rounds():
    n = 20_000
    assert trie.split_sums([i - 1 for i in range(n)], list(range(n, 0, -1)), [[1] * n])[0][0] == n
