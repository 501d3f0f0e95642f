"""The bitmap of a member list: no member is lost, others leave before the exchange."""

import pytest

from ledgerlens.operators.member_filter import bitmap, may_be_listed
from ledgerlens.plans import analyses as A
from ledgerlens.sources import parse_registry, parse_transactions


@pytest.mark.parametrize("n", [0, 1, 3000])
def test_members_pass_and_few_others(spark, n):
    members = spark.range(n).selectExpr("concat('0x', id) AS address").union(spark.createDataFrame([(None,)], "address string"))
    facts = spark.range(-20_000, n).selectExpr("concat('0x', id) AS to_address", "id").union(spark.createDataFrame([(None, -1)], "to_address string, id long"))
    passed = [r.id for r in facts.where(may_be_listed("to_address", members, "address")).collect()]
    assert {i for i in passed if i >= 0} == set(range(n))
    assert len([i for i in passed if i < 0]) <= 20_000 * 0.04 * (n > 0)


def test_a_list_beyond_the_limit_has_no_bitmap(spark):
    members = spark.range(50).selectExpr("concat('0x', id) AS address")
    assert bitmap(members, "address", max_members=49).first().words is None
    assert len(bitmap(members, "address", max_members=50).first().words) == 16
    facts = spark.range(500).selectExpr("concat('0x', id) AS to_address")
    assert facts.where(may_be_listed("to_address", members, "address", max_members=49)).count() == 500


def _exchanged(node) -> dict[str, int]:
    """Rows that each exchange of an executed plan has written, by its key."""
    out: dict[str, int] = {}

    def walk(n):
        name = n.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(n.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(n.plan())
        if name == "ShuffleExchangeExec":
            metric = n.metrics().get("shuffleRecordsWritten").get()
            out[n.outputPartitioning().toString()] = metric.value()
        for i in range(n.children().size()):
            walk(n.children().apply(i))

    walk(node)
    return out


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_the_address_exchange_holds_members_and_false_hits_only(spark, no_broadcast, lines):
    line = "concat_ws(',', '0xh', '0', '0xb', id, '0', '0xf', concat('0xa', id % 5000), '3', '21000', '7', '0x', '1438918233', '', '', '0')"
    tx = parse_transactions(spark.range(20_000).selectExpr(f"{line} AS value").repartition(4))
    registry = parse_registry(lines(['{"success":true,"result":{"h":{"id":1,"category":"Phishing","addresses":["0xa7","0xa8"]}}}']))
    popular = spark.createDataFrame([("0xa7",), ("0xa9",)], "address string")
    for df, want in (
        (A.scam_value_by_id(tx, registry), [(1, 24)]),
        (A.scam_value_by_category_month(tx, registry), [("Phishing", "08-2015", 24)]),
        (A.gas_of_top_contracts(tx, popular), [("0xa7", 84000.0), ("0xa9", 84000.0)]),
    ):
        assert sorted((tuple(r) for r in df.collect()), key=repr) == want
        written = _exchanged(df._jdf.queryExecution().executedPlan())
        by_address = [n for key, n in written.items() if "to_address" in key]
        assert by_address and max(by_address) <= 4 * (2 + 0.04 * 5000)  # per map task: members and false hits, summed


def test_a_malformed_value_stops_the_job_listed_or_not(lines):
    registry = parse_registry(lines(['{"success":true,"result":{"h":{"id":1,"category":"Phishing","addresses":["0xa7"]}}}']))
    tx = parse_transactions(lines(["0xt,0,0xb4,106,0,0xa1,0xzz,oops,21000,1,0x,1441065600,,,0"]))
    for analysis in (A.scam_value_by_id, A.scam_value_by_category_month):
        with pytest.raises(Exception, match="malformed value"):
            analysis(tx, registry).collect()
