"""Ledger-shaped raw text derived, by Spark, from the supplied star schema.

The original ledger dumps are not available, so every analysis also runs on
raw text that Spark builds from the given tables and then parses with the
ordinary readers. The work grows with the tables: every line item is a
transaction, every order a block, every supplier a contract, and the scam
registry is built from suppliers, nations and regions.

Mapping
  transactions  <- lineitem: to_address = supplier (of a few, a part, which no
                   list holds), value = extended price
                   in cents x 10^16 (26-digit wei), gas = quantity x 21000,
                   gas_price = (cents div quantity) x 10^5, timestamp = ship
                   date (+ line number hours).
  contracts     <- supplier (address = supplier); suppliers with a balance
                   above 9000 are listed twice.
  blocks        <- orders: miner = customer, size = cents div 100.
  scam registry <- supplier with balance < 2500: id = suppkey, category by
                   region, addresses = [own, next supplier's] (an address can
                   belong to two entries), none when the balance is negative.
                   One JSON document per page of 64 suppliers.

Dirty rows follow fixed, value-based rules (documented per table below) and
exercise the validity checks: wrong arity from a quoted comma or a missing
field, probes that only look numeric, accepted oddities such as blanks and
underscores, a header line per file.
"""

from __future__ import annotations

import hashlib
import threading
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.schemas import BLOCKS, CONTRACTS, TRANSACTIONS
from ledgerlens.sinks import file_identity, path_exists, publish

# Fixed values of the mirror.
ADDRESS_WIDTH = 40
WEI_PER_CENT_DIGITS = "0000000000000000"  # x 10^16
GAS_PER_UNIT = 21000
GAS_PRICE_SCALE = 100000
UNLISTED_LINE, UNLISTED_TAX = 6, 5
ODD_GAS = ("5.5", "20999.99999999999", "1e30")
QUOTED_INPUT = '"0xa9059cbb,0x01"'
MULTI_SIGHASHES = '"0x06fdde03,0x095ea7b3"'
ONE_SIGHASH = "0x18160ddd"
POOL_TAG = "pool,eu"
REGISTRY_PAGE = 64
SCAM_BALANCE_BELOW = 2500
LISTED_TWICE_ABOVE = 9000
# Region name -> scam category (EUROPE deliberately empty).
REGION_CATEGORY = {
    "AFRICA": "Phishing",
    "AMERICA": "Scamming",
    "ASIA": "Fake ICO",
    "EUROPE": "",
    "MIDDLE EAST": "Phishing",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def address(key: Column) -> Column:
    return F.concat(F.lit("0x"), F.lpad(key.cast("string"), ADDRESS_WIDTH, "0"))


def cents(price: Column) -> Column:
    return F.round(price * F.lit(100)).cast("bigint")


def pct(x: Column) -> Column:
    return F.round(x * F.lit(100)).cast("int")


def day_seconds(df: DataFrame, name: str) -> Column:
    """Epoch seconds of the calendar day of a naive timestamp column.

    Read as ``timestamp_ntz`` (the default for naive Parquet timestamps) the
    day is zone-free; read as a zoned timestamp the stored instant is taken
    in UTC, so the session time zone never shifts a day.
    """
    ts = F.col(name)
    if dict(df.dtypes)[name] == "timestamp_ntz":
        days = F.unix_date(F.to_date(ts)).cast("bigint")
    else:
        days = F.floor(F.unix_micros(ts) / F.lit(86_400_000_000)).cast("bigint")
    return days * F.lit(86400)


def _header(spark: SparkSession, columns) -> DataFrame:
    """The header line of a dump file.

    It is built from a column (an empty substring of the row id) so that it
    is data, as a header read from a file is: a literal line would let the
    optimizer constant-fold the analyses' casts over it at plan time, before
    the validity filter has removed it.
    """
    row = spark.range(0, 1, 1, 1)
    empty = F.substring(F.col("id").cast("string"), 1, 0)
    return row.select(F.concat(F.lit(",".join(columns)), empty).alias("value"))


def transaction_lines(spark: SparkSession, sf_dir: str, header: bool = True) -> DataFrame:
    """Raw transaction text, one line per line item.

    Rules (l_discount, l_tax in percent):
      discount 10          block_number written ``<n>.0``      -> dropped
      tax 0                block_number padded with blanks      -> kept
      discount 0           block_number written ``<n>_0``       -> kept
      returned and open    input is a quoted list with a comma  -> dropped
      tax 8                line stops after gas_price (10 f.)   -> dropped
      line 6, tax 5        sent to the part's address (``0xp``), which no list
                           holds, with gas that is no integer: by the part's
                           key modulo 3 ``5.5``, ``20999.99999999999`` or
                           ``1e30``                             -> kept
    """
    unlisted = (F.col("l_linenumber") == UNLISTED_LINE) & (pct(F.col("l_tax")) == UNLISTED_TAX)
    part = F.col("l_partkey") % 3
    odd_gas = F.when(part == 0, F.lit(ODD_GAS[0])).when(part == 1, F.lit(ODD_GAS[1])).otherwise(F.lit(ODD_GAS[2]))
    li = table(spark, sf_dir, "lineitem")
    ok = F.col("l_orderkey").cast("string")
    ln = F.col("l_linenumber").cast("string")
    disc = pct(F.col("l_discount"))
    tax = pct(F.col("l_tax"))
    c = cents(F.col("l_extendedprice"))
    qty = F.col("l_quantity").cast("bigint")
    block = (
        F.when(disc == 10, F.concat(ok, F.lit(".0")))
        .when(tax == 0, F.concat(F.lit(" "), ok, F.lit(" ")))
        .when(disc == 0, F.concat(ok, F.lit("_0")))
        .otherwise(ok)
    )
    hexkey = F.lower(F.hex(F.col("l_orderkey")))
    fields = [
        F.concat(F.lit("0x"), hexkey, F.lit("0"), ln),                       # hash
        ln,                                                                  # nonce
        F.concat(F.lit("0x"), hexkey),                                       # block_hash
        block,                                                               # block_number
        ln,                                                                  # transaction_index
        address(F.col("l_partkey")),                                         # from_address
        F.when(unlisted, F.concat(F.lit("0xp"), F.col("l_partkey").cast("string")))
        .otherwise(address(F.col("l_suppkey"))),                             # to_address
        F.concat(c.cast("string"), F.lit(WEI_PER_CENT_DIGITS)),              # value
        F.when(unlisted, odd_gas).otherwise((qty * F.lit(GAS_PER_UNIT)).cast("string")),  # gas
        (F.expr("l_c div l_q") * F.lit(GAS_PRICE_SCALE)).cast("string"),     # gas_price
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"),
               F.lit(QUOTED_INPUT)).otherwise(F.lit("0x")),                  # input
        (day_seconds(li, "l_shipdate")
         + F.col("l_linenumber").cast("bigint") * F.lit(3600)).cast("string"),  # block_timestamp
        F.lit(""), F.lit(""), F.lit("0"),
    ]
    assert len(fields) == TRANSACTIONS.arity
    full = F.concat_ws(",", *fields)
    short = F.concat_ws(",", *fields[:10])
    lines = li.withColumn("l_c", c).withColumn("l_q", qty).select(
        F.when(tax == 8, short).otherwise(full).alias("value")
    )
    return _header(spark, TRANSACTIONS.columns).unionByName(lines) if header else lines


def contract_lines(spark: SparkSession, sf_dir: str, header: bool = True) -> DataFrame:
    """Raw contract text, one line per supplier, twice for balances > 9000.

    Rules: negative balance -> quoted list of two sighashes (7 fields,
    dropped); nation 10 or 11 -> ``is_erc20`` written ``true`` (dropped);
    otherwise ``True`` below nation 10, ``False`` above.
    """
    s = table(spark, sf_dir, "supplier")
    nation = F.col("s_nationkey")
    fields = [
        address(F.col("s_suppkey")),
        F.lit("0x6080604052"),
        F.when(F.col("s_acctbal") < 0, F.lit(MULTI_SIGHASHES)).otherwise(F.lit(ONE_SIGHASH)),
        F.when(nation.isin(10, 11), F.lit("true"))
        .when(nation < 10, F.lit("True")).otherwise(F.lit("False")),
        F.lit("False"),
        F.col("s_suppkey").cast("string"),
    ]
    assert len(fields) == CONTRACTS.arity
    once = s.select(F.concat_ws(",", *fields).alias("value"))
    again = s.where(F.col("s_acctbal") > LISTED_TWICE_ABOVE).select(
        F.concat_ws(",", *fields).alias("value")
    )
    lines = once.unionByName(again)
    return _header(spark, CONTRACTS.columns).unionByName(lines) if header else lines


def block_lines(spark: SparkSession, sf_dir: str, header: bool = True) -> DataFrame:
    """Raw block text, one line per order.

    Rules: priority 2-HIGH and status F -> number written in hex (dropped);
    priority 1-URGENT -> extra_data ``pool,eu`` (20 fields, dropped);
    priority 5-LOW and status O -> no base fee field (18 fields, dropped);
    status P -> state_root empty (-1 byte) and receipts_root ``0x`` (0 byte).
    Well-formed hashes are 32 bytes (logs bloom 256), i.e. 384 bytes a block.
    """
    o = table(spark, sf_dir, "orders")
    ok = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    prio = F.col("o_orderpriority")
    hexkey = F.lower(F.hex(ok))

    def h(width: int, salt: str) -> Column:
        return F.concat(F.lit("0x"), F.lpad(F.concat(F.lit(salt), hexkey), width, "0"))

    number = F.when((prio == "2-HIGH") & (status == "F"), F.concat(F.lit("0x"), hexkey)).otherwise(
        ok.cast("string")
    )
    pending = status == "P"
    fields = [
        number,
        h(64, "b"),                                            # hash
        h(64, "p"),                                            # parent_hash
        F.lit("0x0000000000000042"),                           # nonce
        h(64, "u"),                                            # sha3_uncles
        h(512, "l"),                                           # logs_bloom
        h(64, "t"),                                            # transactions_root
        F.when(pending, F.lit("")).otherwise(h(64, "s")),       # state_root
        F.when(pending, F.lit("0x")).otherwise(h(64, "r")),     # receipts_root
        address(F.col("o_custkey")),                           # miner
        F.lit("1"),                                            # difficulty
        ok.cast("string"),                                     # total_difficulty
        F.expr("o_c div 100").cast("string"),                  # size
        F.when(prio == "1-URGENT", F.lit(POOL_TAG)).otherwise(F.lit("0x")),  # extra_data
        F.lit("8000000"),                                      # gas_limit
        F.lit("21000"),                                        # gas_used
        day_seconds(o, "o_orderdate").cast("string"),          # timestamp
        F.lit("1"),                                            # transaction_count
        F.lit(""),                                             # base_fee_per_gas
    ]
    assert len(fields) == BLOCKS.arity
    lines = o.withColumn("o_c", cents(F.col("o_totalprice"))).select(
        F.when((prio == "5-LOW") & (status == "O"), F.concat_ws(",", *fields[:18]))
        .otherwise(F.concat_ws(",", *fields)).alias("value")
    )
    return _header(spark, BLOCKS.columns).unionByName(lines) if header else lines


def _category(region_name: Column) -> Column:
    expr = None
    for name, cat in REGION_CATEGORY.items():
        expr = (F.when(region_name == name, F.lit(cat)) if expr is None
                else expr.when(region_name == name, F.lit(cat)))
    return expr.otherwise(F.lit(""))


def registry_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scam registry JSON text: one document per page of 64 suppliers.

    Every page is bounded, so no single task ever parses an unbounded line.
    Of suppliers with a key divisible by 7 an outdated entry with the same name
    (other id, category Phishing, the next supplier's address) comes first.
    """
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    scams = (
        s.where(F.col("s_acctbal") < SCAM_BALANCE_BELOW)
        .join(n, s["s_nationkey"] == n["n_nationkey"])
        .join(r, n["n_regionkey"] == r["r_regionkey"])
    )
    key = F.col("s_suppkey")
    addresses = F.when(F.col("s_acctbal") < 0, F.array().cast("array<string>")).otherwise(
        F.array(address(key), address(key + F.lit(1)))
    )
    entry = F.struct(
        key.alias("id"),
        F.col("s_name").alias("name"),
        F.concat(F.lower(F.col("s_name")), F.lit(".example")).alias("url"),
        F.lit("ETH").alias("coin"),
        _category(F.col("r_name")).alias("category"),
        F.col("n_name").alias("subcategory"),
        addresses.alias("addresses"),
        F.when(F.col("s_acctbal") < 1000, F.lit("Offline")).otherwise(F.lit("Active")).alias("status"),
    )
    outdated = F.struct(
        (-key).alias("id"),
        F.col("s_name").alias("name"),
        F.lit("Phishing").alias("category"),
        F.array(address(key + F.lit(1))).alias("addresses"),
        F.lit("Active").alias("status"),
    )
    name = F.concat(F.lit('"'), F.lower(F.col("s_name")), F.lit('.example":'))
    text = F.concat(name, F.to_json(entry))
    members = F.when(key % 7 == 0, F.concat(name, F.to_json(outdated), F.lit(","), text)).otherwise(text)
    pages = scams.groupBy(F.floor(key / F.lit(REGISTRY_PAGE)).alias("page")).agg(
        F.concat_ws(",", F.collect_list(members)).alias("members")
    )
    return pages.select(F.concat(F.lit('{"success":true,"result":{'), F.col("members"), F.lit("}}")).alias("value"))


def popular_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored popular-contract list: Q04's result on the mirror, written as
    headerless ``address,total`` lines with the total in e-notation (the
    value is informational; readers only use the address)."""
    from ledgerlens.plans.analyses import top_contracts_by_value
    from ledgerlens.sources.ledger import parse_contracts, parse_transactions

    top = top_contracts_by_value(
        parse_transactions(staged_lines(spark, sf_dir, "transactions")),
        parse_contracts(staged_lines(spark, sf_dir, "contracts")),
    )
    return top.select(
        F.concat(F.col("address"), F.lit(","),
                 F.format_string("%.5E", F.col("total").cast("double"))).alias("value")
    )


# --- staging: the mirror written once as text files, read like a real dump -------------

def _package_digest() -> str:
    """Hash of the package's own source: the staged text and the typed
    staging depend on the builders, readers and column functions, so any
    change to them gives new folders and stale data is never read back."""
    h = hashlib.sha1()

    def walk(node, prefix: str) -> None:  # works in a folder and inside a zip
        for child in sorted(node.iterdir(), key=lambda c: c.name):
            if child.is_dir():
                if prefix or child.name != "llm":  # not read by any of them
                    walk(child, f"{prefix}{child.name}/")
            elif child.name.endswith(".py"):
                h.update(f"{prefix}{child.name}".encode() + child.read_bytes())

    walk(resources.files("ledgerlens"), "")
    return h.hexdigest()[:12]


MIRROR_VERSION = _package_digest()
_STAGE_LOCK = threading.RLock()  # re-entrant: a builder may stage its own inputs
BUILDERS = {
    "transactions": transaction_lines,
    "contracts": contract_lines,
    "blocks": block_lines,
    "registry": registry_lines,
    "popular": popular_lines,
}

#: Kinds whose text is made of numbers and fixed words only: no line break can
#: stand in it, so a file of it holds the lines that were built.
UNBROKEN = ("transactions", "contracts", "blocks")
#: Lines in one staged file. Readers pack files into a task by bytes and a fixed
#: cost for each file, so this bounds the rows that one task sums.
LINES_PER_FILE = 100_000
#: The same for typed Parquet, whose few bytes a row else put millions of rows,
#: and of their sums, into one split.
ROWS_PER_FILE = 25_000

#: The tables that each staged text is built from.
SOURCES = {
    "transactions": ("lineitem",),
    "contracts": ("supplier",),
    "blocks": ("orders",),
    "registry": ("supplier", "nation", "region"),
    "popular": ("lineitem", "supplier"),
}


def stage_folder(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Folder of the staged ``kind`` for ``sf_dir`` under the shared checkpoint
    folder. Its name covers the package source and the name, length and
    modification time of every input file, so a table that changes under the
    same path gets a new folder."""
    from ledgerlens.session import ensure_checkpoint_dir

    root, base = ensure_checkpoint_dir(spark).rstrip("/"), sf_dir.rstrip("/")
    files = [file_identity(spark, f"{base}/{t}.parquet") for t in SOURCES[kind.split(".")[0]]]
    digest = hashlib.sha1(f"{MIRROR_VERSION}|{base}|{files}".encode()).hexdigest()[:16]
    return f"{root}/ledgerlens-mirror/{digest}/{kind}"


def staged_lines(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Raw ledger text of ``kind`` for the tables in ``sf_dir``, as text files.

    The text is built by Spark from the tables and written once under the
    cluster's shared checkpoint folder (``spark.checkpoint.dir``); every later
    call reads the files back with ``spark.read.text``, exactly as the dumps
    themselves are read: many tasks, no lineage back to the builder. The files
    are gzip, which no reader splits, so each holds ``LINES_PER_FILE`` lines at
    most. A folder counts only once its ``_SUCCESS`` marker is written.
    """
    path = stage_folder(spark, sf_dir, kind)
    options = {"compression": "gzip", "maxRecordsPerFile": LINES_PER_FILE}
    return _staged(spark, path, lambda: publish(spark, BUILDERS[kind](spark, sf_dir), path, "text", existing="keep", options=options),
                   lambda: spark.read.text(path))


def _staged(spark: SparkSession, path: str, build, read) -> DataFrame:
    """Read a staged folder, building it first when it is not (or no longer)
    complete; a folder removed behind this process's back is built again."""
    for attempt in (0, 1):
        with _STAGE_LOCK:
            if path not in _STAGED:
                if not path_exists(spark, f"{path}/_SUCCESS"):
                    build()
                _STAGED.add(path)
        try:
            return read()
        except Exception:
            _STAGED.discard(path)
            if attempt:
                raise
    raise AssertionError("unreachable")


_STAGED: set[str] = set()  # folders known complete in this process


def staged_table(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Validated, typed rows of ``kind`` as Parquet (see ``sources.typed``).

    Parsed once from the text with the ordinary readers and written under the
    shared checkpoint folder; analyses read only the columns they use from it.
    The text of ``UNBROKEN`` kinds is parsed as it is built, without files of
    it in between.
    """
    from ledgerlens.sources import ledger as L
    from ledgerlens.sources import typed as T

    parse, typed = {
        "transactions": (L.parse_transactions, T.typed_transactions),
        "contracts": (L.parse_contracts, T.typed_contracts),
        "blocks": (L.parse_blocks, T.typed_blocks),
        "registry": (L.parse_registry, T.typed_registry),
    }[kind]

    def lines() -> DataFrame:
        if kind not in UNBROKEN:
            return staged_lines(spark, sf_dir, kind)
        # Filters stay above a generator: each line is built once, not for the
        # check and the fields anew.
        return BUILDERS[kind](spark, sf_dir).select(F.explode(F.array("value")).alias("value"))

    path = stage_folder(spark, sf_dir, f"{kind}.typed")
    return _staged(
        spark, path,
        lambda: publish(spark, typed(parse(lines())), path, "parquet", existing="keep", options={"maxRecordsPerFile": ROWS_PER_FILE}),
        lambda: spark.read.parquet(path),
    )

