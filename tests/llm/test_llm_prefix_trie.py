import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from leaguelake.llm import prefix_trie
from leaguelake.llm.prefix_trie import SpillingQueue, prefix_trie as plain_trie, rebuilt_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WIDER = SCHEMA + ", depth int, x string, y string, a string, place string, length string"


def conversations_of(rows):
    out = defaultdict(list)
    for row in rows:
        if row[0] is not None:
            out[row[0]].append((row[1] is not None, row[1] or 0, row[2] or "", row[3] or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in out.items()}


def rebuilt_by_hand(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    return out


def brute_force(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below = defaultdict(list)
    for node in members:
        for d in range(len(node) + 1):
            below[node[:d]].append(node)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    out = []
    for node, mine in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in mine if len(convs[c]) == len(node)))
        out.append((
            min(mine), len(node), min(members[node[:-1]]) if node else None, len(mine), children[node], sum(not children[n] for n in below[node]),
            sum((len(members[n]) - 1) * (len(n[-1][1]) if n else 0) for n in below[node]), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_rows(seed, n_convs):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(0, 450), n_convs):
        turns = range(rng.choice([1, 2, 3, 5, 8, 12]))
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["hi", "yes", "no", "ça va", "🙂 ok"]) * rng.choice([1, 1, 2])) for t in turns]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = random_rows(seed, 150)
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(rebuilt_trie(df)) == brute_force(rebuilt_by_hand(conversations_of(rows)))
    assert result(plain_trie(df)) == brute_force(conversations_of(rows))


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in df.collect()]
    assert result(rebuilt_trie(df)) == brute_force(rebuilt_by_hand(conversations_of(rows)))


def test_copies_chains_and_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 7)
    rows = [(c, t, "user", f"t{t}") for c in range(1, 40) for t in range(20)]  # copies
    rows += [(c, t, "user", f"s{t}") for c in range(50, 80) for t in range(c - 49)]  # each ends a turn later
    rows += [(100, t, "user", f"t{t}" if t < 60 else f"u{t}") for t in range(120)]  # long, begins like the copies
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(plain_trie(df)) == brute_force(conversations_of(rows))
    assert result(rebuilt_trie(df)) == brute_force(rebuilt_by_hand(conversations_of(rows)))


def test_defined_cases(spark):
    rows = [
        (100, None, "user", "first"), (100, 0, None, "second"), (100, 1, "user", None), (100, 1, "user", None), (101, 5, "user", "x" * 200_000),
        (None, 0, "user", "nobody"), (207, 0, "user", "no base"), (-5, 0, "user", "first"), (-5, 0, "assistant", "tie"),
    ]
    clashing = spark.createDataFrame([(*r, 1, "x", "y", "a", "p", "l") for r in rows], WIDER)
    by_hand = conversations_of(rows)
    assert result(plain_trie(clashing)) == brute_force(by_hand)
    for empty in ([], [(None, 1, "user", "x")]):
        assert result(rebuilt_trie(spark.createDataFrame(empty, SCHEMA))) == []


def test_turnless_conversations_are_members_of_the_root(spark):
    turnless = [c for c in range(201, 300) if zlib.crc32(str(c).encode()) % 6 >= 2][:30]
    rows = [(c, t, "user", f"{c}") for c in turnless for t in range(2)]
    got = result(rebuilt_trie(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute_force(rebuilt_by_hand(conversations_of(rows))) and len(got) == 1 and got[0][3] == 30


def test_ends_of_one_node_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "HASHED_IDS", 16)
    rows = [(c, 0, "user", "same") for c in range(500)]
    assert result(plain_trie(spark.createDataFrame(rows, SCHEMA))) == brute_force(conversations_of(rows))


def test_queue_spills_and_keeps_order():
    rng = random.Random(3)
    queue, items, out = SpillingQueue(limit=50), [(rng.randrange(100), i) for i in range(2000)], []
    for item in items[:1000]:
        queue.push(item)
    while len(out) < 500:
        assert queue.first() is not None
        out.append(queue.pop())
    assert out == sorted(items[:1000])[:500]
    for item in items[1000:]:
        queue.push(item)
    rest = []
    while queue.first() is not None:
        first = queue.first()
        rest.append(queue.pop())
        assert rest[-1] == first
    assert rest == sorted(set(items) - set(out)) and not len(queue)
