import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from spillway.llm import conversation_trie as trie
from spillway.llm.common import Workspace
from spillway.llm.queries import op11_conversation_trie
from tests.llm.helpers import clashing

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def lists_of(rows):
    """conv_id -> its (role, text) in order; turns of one number by role."""
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            found[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in found.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(convs):
    """A trie by dictionaries of whole prefixes, and a plain recursion."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = own + sum(saved[k] for k in children[node])
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(node)).encode()).hexdigest())
                  for node, m in members.items())


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def table_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def random_rows(seed, convs=60, kinds=2, most=14):
    rng = random.Random(seed)
    rows = []
    for _ in range(convs):
        c = rng.choice([rng.randrange(-20, 60), rng.randrange(10**12)])
        for turn in rng.sample(range(30), rng.randrange(most)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["", None, "a", "bé"][:kinds + 1])))
    return rng.sample(rows, len(rows))


def distinct_turns(rows):
    return list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())


@pytest.mark.parametrize("seed", range(3))
def test_trie_by_definition(spark, seed):
    rows = distinct_turns(random_rows(seed))
    assert rows_of(trie.trie_of(table_of(spark, rows), Workspace(spark, "t"))) == brute(lists_of(rows))


@pytest.mark.parametrize("seed", range(3, 5))
def test_rebuilt_trie_by_definition(spark, seed):
    rows = distinct_turns(random_rows(seed, convs=120))
    assert rows_of(trie.rebuilt_trie(table_of(spark, rows), Workspace(spark, "t"))) == brute(rebuilt(lists_of(rows)))


def test_nested_and_equal_conversations(spark):
    """Conversations that end inside others, at block ends too, equal ones, and one turn that all share."""
    turns = [("user" if i % 2 else "assistant", f"text {i}") for i in range(13)]
    rows = [(c, i, *turns[i]) for c in range(13) for i in range(13 - c)] + [(100 + c, i, *turns[i]) for c in range(5) for i in range(8)]
    rows += [(200 + c, i, *(turns[i] if i != 6 else ("user", f"other {c % 2}"))) for c in range(4) for i in range(9)]
    assert rows_of(trie.trie_of(table_of(spark, rows), Workspace(spark, "t"))) == brute(lists_of(rows))


def test_long_conversation_in_stripes(spark, monkeypatch):
    monkeypatch.setattr(trie, "STRIPE", 3)
    rows = [(c, i, "user", f"t{i}" if i < 40 else f"t{i} of {c % 2}") for c in (7, 3, 9) for i in range(60)]
    assert rows_of(trie.trie_of(table_of(spark, rows), Workspace(spark, "t"))) == brute(lists_of(rows))


def test_many_ends_at_one_node(spark):
    rows = [(c, 0, "user", "same") for c in (*range(-70_000, 70_000, 997), 5, 10**15)]
    assert rows_of(trie.trie_of(table_of(spark, rows), Workspace(spark, "t"))) == brute(lists_of(rows))


def test_given_conversations(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(op11_conversation_trie(spark, sf)) == brute(rebuilt(lists_of(rows)))


def test_odd_cases(spark):
    rows = [(None, 0, "user", "nobody's"), (1, None, "user", "first"), (1, 0, None, None), (1, 0, None, None), (2, 5, "user", "x" * 200_000),
            (2, 6, "user", ""), (9223372036854775807, 1, "user", "first"), (-9223372036854775808, 1, "", "first")]
    assert rows_of(trie.trie_of(table_of(spark, rows), Workspace(spark, "t"))) == brute(lists_of(rows))
    assert rows_of(trie.rebuilt_trie(clashing(table_of(spark, rows)), Workspace(spark, "t"))) == brute(rebuilt(lists_of(rows)))
    assert rows_of(trie.trie_of(table_of(spark, []), Workspace(spark, "t"))) == []
    assert rows_of(trie.trie_of(table_of(spark, rows[:1]), Workspace(spark, "t"))) == []
    only = [(c, 0, "user", "lost") for c in (7, 8)]  # rebuilt: no lender, and all own turns taken away for some
    assert rows_of(trie.rebuilt_trie(table_of(spark, only), Workspace(spark, "t"))) == brute(rebuilt(lists_of(only)))
