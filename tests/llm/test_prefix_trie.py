import hashlib
import random
import zlib
from collections import defaultdict

from ledgerlens.llm.prefix_trie import end_lists, leaves, prefix_trie, prefixes, rebuilt_turns, sequences

SCHEMA = "conv_id long, turn long, role string, text string, depth string, p1 string, c int"


def frame(spark, rows, partitions=3):
    df = spark.createDataFrame([(*r, "clash", "p", 1) for r in rows], SCHEMA)
    return df.repartition(partitions) if rows else df


def said(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def rebuilt(rows, group=5, shared=9):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, said(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % shared
        out[c] = tuple(own.get(c - c % group, [])[:h] + ts[h:])
    return out


def expected(rows, **settings):
    convs = rebuilt(rows, **settings)
    members = defaultdict(list)
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children, below = defaultdict(int), defaultdict(lambda: [0, 0])
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        saved = (len(own) - 1) * (len(node[-1][1].encode()) if node else 0)
        for d in range(len(node) + 1):
            below[node[:d]][0] += saved
            below[node[:d]][1] += node not in children
    out = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(node))
        out.append((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), children.get(node, 0), below[node][1], below[node][0], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert [t for _, t in df.dtypes] == ["bigint"] * 7 + ["string"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def talks(seed=1, n=70):
    rng = random.Random(seed)
    lines = ["hi", "hello there", "été", "", None, "what?\nno", "x" * 300]
    rows = []
    for c in range(n):
        first = rng.choice(lines[:2])
        for turn in range(rng.randint(1, 12)):
            text = first if turn == 0 else rng.choice(lines) if rng.random() < 0.3 else f"line {turn}"
            rows.append((c, rng.choice([turn, turn, turn, None]) if rng.random() < 0.1 else turn, rng.choice(["user", None]) if rng.random() < 0.1 else "user", text))
    rows += rows[5:8]  # repeated rows
    rows += [(10_000 + 5 * i, 0, "user", "hi") for i in range(3)] + [(2**62, 3, "a", "b"), (None, 1, "user", "lost"), (None, None, None, None)]
    return rows


def test_equals_brute_force(spark):
    rows = talks()
    assert got(prefix_trie(frame(spark, rows))) == expected(rows)


def test_small_steps_and_pieces_change_nothing(spark):
    rows = talks(3, 40) + [(c, t, "user", f"long {t}") for c in (500, 505, 510, 515) for t in range(40)]
    assert got(prefix_trie(frame(spark, rows), group=3, shared=7, step=4, piece=3)) == expected(rows, group=3, shared=7)


def test_identical_conversations_collapse_and_prefixes_are_no_leaves(spark):
    # shared=1: nothing is taken from other conversations
    rows = [(c, t, "user", f"t{t}") for c, k in ((1, 2), (2, 2), (3, 4), (4, 0), (5, 4)) for t in range(k)]
    rows += [(4, 0, "user", "alone")]
    turns, lengths = rebuilt_turns(frame(spark, rows), shared=1)
    ends, collapsed = sequences(turns, lengths)
    assert sorted((r.c, r.depth, r.weight) for r in collapsed.collect()) == [(1, 2, 2), (3, 4, 2), (4, 1, 1)]
    paths = prefixes(turns, collapsed)
    assert sorted(r.c for r in leaves(paths, collapsed).collect()) == [3, 4]
    digests = {r.depth: r.ends_sha256 for r in end_lists(ends).collect()}
    assert digests[2] == hashlib.sha256(b"1,2").hexdigest() and digests[4] == hashlib.sha256(b"3,5").hexdigest()
    assert got(prefix_trie(frame(spark, rows), shared=1)) == expected(rows, shared=1)


def test_turnless_conversations_are_members_of_the_root(spark):
    c = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(c, 0, "user", "a"), (c, 1, "user", "b")]
    assert got(prefix_trie(frame(spark, rows))) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())] == expected(rows)


def test_one_long_conversation_and_many_copies(spark):
    rows = [(0, t, "user", f"{t} " * (t % 7)) for t in range(400)]
    rows += [(5 * c, 0, "user", "same") for c in range(1, 150)]
    assert got(prefix_trie(frame(spark, rows, 8), step=64, piece=64)) == expected(rows)


def test_very_long_texts_count_whole(spark):
    long = "word " * 300_000
    rows = [(c, t, "user", long + ("x" if t else "")) for c in (0, 5) for t in range(2)] + [(10, 0, "user", long), (10, 1, "user", long + "y")]
    assert got(prefix_trie(frame(spark, rows))) == expected(rows)


def test_empty_tables(spark):
    assert got(prefix_trie(frame(spark, []))) == []
    assert got(prefix_trie(frame(spark, [(None, 1, "user", "x")]))) == []
