"""Generated ledgers: each analysis against a plain-Python statement of its spec."""

import time
from collections import Counter, defaultdict
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlens.plans import analyses as A
from ledgerlens.sources import parse_contracts, parse_registry, parse_transactions

ADDRS = ["0xa", "0xb", "0xc", ""]

row = st.fixed_dictionaries(
    {
        "to": st.sampled_from(ADDRS),
        "value": st.integers(min_value=0, max_value=10**30),
        "ts": st.integers(min_value=1_420_070_400, max_value=1_548_979_200),
        "gas": st.integers(min_value=21000, max_value=8_000_000),
        "block": st.sampled_from(["7", " 8 ", "9_0", "x1", "1.0", ""]),
        "extra": st.booleans(),
    }
)


def line(r):
    fields = ["0xh", "0", "0xb", r["block"], "0", "0xf", r["to"], str(r["value"]), str(r["gas"]),
              "1", "0x", str(r["ts"]), "", "", "0"]
    return ",".join(fields + (["x"] if r["extra"] else []))


def keep(r):
    if r["extra"]:
        return False
    try:
        int(r["block"])
        return True
    except ValueError:
        return False


def month(ts):
    return time.strftime("%m-%Y", time.gmtime(ts))


SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows=st.lists(row, min_size=0, max_size=40), parts=st.integers(min_value=1, max_value=5))
def test_monthly_stats_match_spec(spark, rows, parts):
    df = spark.createDataFrame([(line(r),) for r in rows], "value string").repartition(parts)
    got = {r.month: (r.n, r.total) for r in A.monthly_value_stats(parse_transactions(df)).collect()}
    n, total = Counter(), defaultdict(int)
    for r in rows:
        if keep(r):
            n[month(r["ts"])] += 1
            total[month(r["ts"])] += r["value"]
    assert got == {m: (n[m], Decimal(total[m])) for m in n}


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=40), listed=st.lists(st.sampled_from(ADDRS), max_size=6))
def test_contract_totals_keep_multiplicity(spark, rows, listed):
    df = spark.createDataFrame([(line(r),) for r in rows], "value string")
    con = spark.createDataFrame([(f"{a},0x60,0xab,True,False,1",) for a in listed], "value string")
    got = Counter((r.address, r.total) for r in
                  A.contract_value_totals(parse_transactions(df), parse_contracts(con)).collect())
    totals = defaultdict(int)
    seen = set()
    for r in rows:
        if keep(r):
            totals[r["to"]] += r["value"]
            seen.add(r["to"])
    want = Counter()
    for a in listed:
        if a in seen:
            want[(a, Decimal(totals[a]))] += 1
    assert got == want


SCAMS = ["0xa", "0xb", "0xc", "0xd"]
entry = st.fixed_dictionaries(
    {
        "id": st.integers(min_value=1, max_value=50),
        "category": st.sampled_from(["Phishing", "Scamming", "Fake ICO", ""]),
        "addresses": st.lists(st.sampled_from(SCAMS), max_size=3),
    }
)


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=30), entries=st.lists(entry, max_size=6),
       names=st.lists(st.integers(0, 4), min_size=6, max_size=6))
def test_scam_analyses_match_spec(spark, rows, entries, names):
    import json

    rows = [dict(r, to=SCAMS[i % len(SCAMS)] if i % 2 else r["to"]) for i, r in enumerate(rows)]
    # Entries may share a name: as in json.loads, the last one counts.
    members = ",".join(f'"e{names[i]}.example":{json.dumps(e)}' for i, e in enumerate(entries))
    text = '{"success":true,"result":{' + members + "}}"
    entries = list(json.loads(text)["result"].values())
    tx = parse_transactions(spark.createDataFrame([(line(r),) for r in rows], "value string"))
    reg = parse_registry(spark.createDataFrame([(text,)], "value string"))
    by_id = {r.id: r.total for r in A.scam_value_by_id(tx, reg).collect()}
    by_cat = {(r.category, r.month): r.total for r in A.scam_value_by_category_month(tx, reg).collect()}
    want_id, want_cat = defaultdict(int), defaultdict(int)
    hit_id, hit_cat = set(), set()
    for e in entries:
        for a in e["addresses"]:
            for r in rows:
                if keep(r) and r["to"] == a:
                    want_id[e["id"]] += r["value"]
                    hit_id.add(e["id"])
                    if e["category"]:
                        want_cat[(e["category"], month(r["ts"]))] += r["value"]
                        hit_cat.add((e["category"], month(r["ts"])))
    assert by_id == {k: Decimal(want_id[k]) for k in hit_id}
    assert by_cat == {k: Decimal(want_cat[k]) for k in hit_cat}


block_row = st.fixed_dictionaries(
    {
        "number": st.sampled_from(["1", " 2 ", "3_0", "0x4", "5.0"]),
        "miner": st.sampled_from(["0xm1", "0xm2", "0xm3"]),
        "size": st.integers(min_value=0, max_value=10**9),
        "hashes": st.lists(st.sampled_from(["", "0x", "0x" + "ab" * 32, "0x" + "cd" * 256]), min_size=5, max_size=5),
        "arity": st.sampled_from([19, 19, 19, 18, 20]),
    }
)


def block_line(b):
    f = [b["number"], "0xh", "0xp", "0x42", *b["hashes"], b["miner"], "1", "1", str(b["size"]), "0x",
         "8000000", "21000", "1438918233", "1", ""]
    f = f[: b["arity"]] + ["x"] * max(0, b["arity"] - 19)
    return ",".join(f)


@SETTINGS
@given(blocks=st.lists(block_row, min_size=0, max_size=30))
def test_block_analyses_match_spec(spark, blocks):
    from ledgerlens.sources import parse_blocks

    df = parse_blocks(spark.createDataFrame([(block_line(b),) for b in blocks], "value string"))
    kept = []
    for b in blocks:
        try:
            int(b["number"])
        except ValueError:
            continue
        if b["arity"] == 19:
            kept.append(b)
    sizes = defaultdict(int)
    for b in kept:
        sizes[b["miner"]] += b["size"]
    want_top = sorted(sizes.items(), key=lambda kv: (-kv[1], kv[0]))[:10]
    got_top = [(r.miner, r.total_size) for r in A.top_miners_by_block_size(df).collect()]
    assert got_top == want_top
    got = [r.bytes for r in A.block_column_overhead(df).collect()]
    want = sum((len(h) - 2) / 2 for b in kept for h in b["hashes"])
    assert got == ([want] if kept else [])
