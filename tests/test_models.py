"""Model behaviour the test tables do not reach, and the tables written."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from parity.catalog import Tables
from tallybook.operators.checks import key_report
from tallybook.plans import binance, bybit, kraken, marts, models
from tallybook.plans.models import HUB_KEYS, MODELS, build_tables, check_tables, write_model
from tallybook.sources import sink
from tallybook.sources.schemas import SCHEMAS
from tallybook.sources.tables import conform, parquet_reader, table_reader


def export(spark, name, *rows):
    """Rows given as dictionaries; columns left out are NULL."""
    schema = SCHEMAS[name]
    df = spark.createDataFrame([[row.get(f.name) for f in schema] for row in rows], schema)
    return df


def at(spark, text):
    return spark.sql(f"select timestamp'{text}' x").first().x


TRADE = {
    "execQty": "1", "orderQty": "1", "execPrice": "1", "markPrice": "1", "orderPrice": "1", "execValue": "1",
    "execFee": "0.00019", "execTime": 1704067200500, "side": "Buy", "execType": "Trade",
}


def test_trade_keys_meet_only_when_normalised(spark):
    trades = export(spark, "bybit_trades", TRADE | {"symbol": "BTCUSDT", "execId": "e", "orderId": "o"})
    hub = bybit.hub_bybit_trade(trades, "run").first()
    assert hub.bk_crypto_trade == "bybit_btcusdt_e"
    assert bybit.sat_bybit_trade(trades, "run").first().fk_bybit_trade != hub.pk_bybit_trade
    assert bybit.link_bybit_trade_bybit_order(trades, "run").first().fk_bybit_trade != hub.pk_bybit_trade
    assert bybit.sat_bybit_trade(trades, "run", normalise_keys=True).first().fk_bybit_trade == hub.pk_bybit_trade
    linked = bybit.link_bybit_trade_bybit_order(trades, "run", normalise_keys=True).first()
    assert linked.fk_bybit_trade == hub.pk_bybit_trade


def test_order_keys_meet_only_when_normalised(spark):
    order = {"orderId": "o", "qty": "1", "price": "1", "cumExecValue": "1", "cumExecFee": "1", "createdTime": 1}
    orders = export(spark, "bybit_orders", order, order | {"createdTime": 2, "orderStatus": "Filled"})
    hub = bybit.hub_bybit_order(orders, "run").collect()
    sat = bybit.sat_bybit_order(orders, "run").collect()
    assert len(hub) == len(sat) == 1 and sat[0].order_status == "Filled"
    assert hub[0].pk_bybit_order != sat[0].fk_bybit_order
    assert bybit.hub_bybit_order(orders, "run", normalise_keys=True).first().pk_bybit_order == sat[0].fk_bybit_order


def test_hub_and_satellite_keep_the_same_execution(spark):
    first = TRADE | {"execId": "e", "symbol": "AUSDT", "orderId": "o"}
    trades = export(spark, "bybit_trades", first | {"symbol": "BUSDT"}, first, first | {"execTime": 1})
    assert bybit.hub_bybit_trade(trades, "run").first().bk_crypto_trade == "bybit_ausdt_e"
    kept = bybit.sat_bybit_trade(trades, "run").first()
    assert kept.symbol == "AUSDT" and str(kept.fee_amount) == "0.0001"


def test_funding_of_two_contracts_at_one_time(spark):
    funding = {"updateReason": "fundingRealisation", "timestamp": 5, "fillTime": 5}
    positions = export(
        spark, "kraken_positions", funding | {"tradeable": "PF_B"}, funding | {"tradeable": "PF_A"},
        {"updateReason": "trade", "timestamp": 5, "fillTime": 5, "executionUid": "e", "tradeable": "PF_A"},
    )
    texts = [r.bk_kraken_position for r in kraken.hub_kraken_position(positions, "run").collect()]
    assert sorted(texts) == ["kraken_futures_e_5", "kraken_futures_funding_pf_a_5"]
    assert kraken.sat_kraken_position(positions, "run").count() == 2
    assert kraken.hub_kraken_position(positions, "run", normalise_keys=True).count() == 3
    assert kraken.sat_kraken_position(positions, "run", normalise_keys=True).count() == 3


def test_records_without_id_are_not_deduplicated(spark):
    payin = {"order_id": "1", "status": "Successful", "amount": "1.239", "fee": "0", "payin_local_at": None}
    payins = export(spark, "binance_payins", payin, payin, payin | {"status": "Failed"})
    assert binance.hub_binance_payin(payins, "run").count() == 2
    assert [str(r.amount) for r in binance.sat_binance_payin(payins, "run").collect()] == ["1.23", "1.23"]


def test_natural_keys_differing_in_case_collide(spark):
    order = {"order_utc_at": at(spark, "2024-01-01 00:00:00"), "pair": "P", "type": "T", "status": "FILLED"}
    orders = export(spark, "binance_orders_spot", order | {"side": "BUY"}, order | {"side": "buy"})
    found = binance.hub_binance_order(orders, "run").collect()
    assert [r.bk_binance_order for r in found] == ["binance_buy_1704067200_p_t_1"] * 2


def test_amounts_rank_as_text(spark):
    order = {
        "side": "BUY", "order_utc_at": at(spark, "2024-01-01 00:00:00.7"), "pair": "P", "type": "T", "status": "FILLED",
        "order_amount": "1.0A", "order_price": "1", "executed": "1.0A", "average_price": "1",
    }
    orders = export(spark, "binance_orders_spot", order | {"trading_total": "9.5B"}, order | {"trading_total": "10.5B"})
    hub = {r.pk_binance_order: r.bk_binance_order for r in binance.hub_binance_order(orders, "run").collect()}
    sat = {hub[r.fk_binance_order]: r for r in binance.sat_binance_order(orders, "run").collect()}
    assert str(sat["binance_buy_1704067200_p_t_1"].trade_amount) == "10.50000000"
    assert sat["binance_buy_1704067200_p_t_1"].order_at == at(spark, "2024-01-01 00:00:00")


@pytest.mark.parametrize(
    ("hub", "sat"),
    [(f"hub_binance_{x}", f"sat_binance_{x}") for x in ("order", "payin", "trade", "transaction")]
    + [("hub_bybit_kline", "sat_bybit_kline"), ("hub_bybit_pnl", "sat_bybit_pnl")]
    + [(f"hub_kraken_{x}", f"sat_kraken_{x}") for x in ("ohlc", "position", "ticker", "transaction")],
)
def test_hub_and_satellite_have_the_same_keys(spark, small, hub, sat):
    tables = Tables(spark, small)
    pk, fk = tables[hub].columns[0], tables[sat].columns[0]
    hubs, sats = tables[hub].select(F.col(pk).alias("k")), tables[sat].select(F.col(fk).alias("k"))
    assert hubs.exceptAll(sats).isEmpty() and sats.exceptAll(hubs).isEmpty()


def test_audit_columns_follow_the_keys(spark, small):
    tables = Tables(spark, small)
    for name, model in MODELS.items():
        columns = tables[name].columns
        if name in ("calc_bybit_pnl_per_trade", "calc_kraken_pnl_per_trade"):
            assert "record_source" not in columns
            continue
        places = columns.index("record_source"), columns.index("load_dts")
        assert places[1] == places[0] + 1
        assert all(re.match("[pfb]k_", c) for c in columns[: places[0]]), name
        assert model.sort_by is None or model.sort_by in columns


def test_exports_must_have_their_declared_types(spark):
    df = export(spark, "binance_payins")
    assert conform(df.withColumn("more", F.lit(1)), "binance_payins").columns == SCHEMAS["binance_payins"].names
    with pytest.raises(ValueError, match="amount is missing"):
        conform(df.drop("amount"), "binance_payins")
    candles = export(spark, "kraken_ohlc_eur_usd").withColumn("time", F.lit("12")).withColumn("open", F.lit("1.5"))
    assert conform(candles, "kraken_ohlc_eur_usd").schema.simpleString() == SCHEMAS["kraken_ohlc_eur_usd"].simpleString()
    with pytest.raises(ValueError, match=r"decimal\(18,9\) is not decimal\(18,8\)"):
        conform(candles.withColumn("open", F.lit("1.5").cast("decimal(18,9)")), "kraken_ohlc_eur_usd")
    with pytest.raises(ValueError, match="double is not string"):
        conform(df.withColumn("amount", F.lit(1.5)), "binance_payins")
    zoneless = df.withColumn("payin_local_at", F.col("payin_local_at").cast("timestamp_ntz"))
    assert conform(zoneless, "binance_payins").schema == df.schema


def test_tables_are_written_by_layer(spark, small, tmp_path):
    tables = Tables(spark, small)
    for name in SCHEMAS:
        tables[name].write.parquet(f"{tmp_path}/{name}")
    read = parquet_reader(spark, str(tmp_path))
    written = build_tables(spark, read, run_id="it's \\run 1")
    assert len(written) == len(MODELS) == 32
    assert "vault_raw.hub_binance_order" in written and "mart_core.fact_bybit_trade" in written
    for name, model in MODELS.items():
        table = spark.table(sink.table_name(model.layer, name))
        assert table.count() == tables[name].count(), name
    audited = spark.table("mart_core.fact_bybit_trade").select("record_source").distinct().collect()
    assert [r.record_source for r in audited] == ["it's \\run 1"]

    report = check_tables(spark).collect()
    assert len(report) == 24 and {r.model for r in report} == set(HUB_KEYS)
    repeating = {r.model for r in report if r.failures}
    assert "hub_binance_order" not in repeating and "hub_bybit_trade" not in repeating

    # A second run replaces the rows; other environments have one namespace.
    before = spark.table("vault_raw.hub_binance_payin").count()
    assert build_tables(spark, read, ["hub_binance_payin"]) == ["vault_raw.hub_binance_payin"]
    assert spark.table("vault_raw.hub_binance_payin").count() == before
    assert build_tables(spark, read, ["hub_binance_payin"], env="test") == ["dev.hub_binance_payin"]
    with pytest.raises(ValueError, match="no such model"):
        build_tables(spark, read, ["nothing"])

    spark.sql("create namespace if not exists source")
    read("binance_payins").write.mode("overwrite").saveAsTable("source.binance_payins")
    assert table_reader(spark)("binance_payins").count() == read("binance_payins").count()


def test_models_built_side_by_side(spark, small, tmp_path):
    tables = Tables(spark, small)
    names = [n for n in MODELS if "binance" in n and "order" not in n]
    for name in {r for n in names for r in MODELS[n].reads if r not in MODELS}:
        tables[name].write.parquet(f"{tmp_path}/{name}")
    read = parquet_reader(spark, str(tmp_path))
    written = build_tables(spark, read, names, env="test", default="threaded", threads=4)
    assert written == [f"threaded.{n}" for n in names]
    assert all(spark.table(f"threaded.{n}").count() == tables[n].count() for n in names)


def test_a_model_waits_for_what_it_reads_and_a_failure_ends_the_run():
    import threading
    import time

    lock, log = threading.Lock(), []

    def build(name):
        with lock:
            log.append(("begin", name))
        time.sleep(0.01)
        with lock:
            log.append(("end", name))
        if name == broken:
            raise ValueError(name)
        return name

    broken = None
    assert models._side_by_side(list(MODELS), build, 5) == list(MODELS)
    for name, model in MODELS.items():
        for read in model.reads:
            if read in MODELS:
                assert log.index(("end", read)) < log.index(("begin", name))
    log.clear()
    broken = "sat_bybit_trade"
    with pytest.raises(ValueError, match=broken):
        models._side_by_side(list(MODELS), build, 3)
    assert ("begin", "calc_bybit_pnl_per_trade") not in log and ("begin", "fact_bybit_trade") not in log


def counting(spark, rows):
    """Rows, and how many were read from them so far."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return rows.mapInArrow(count, rows.schema), read


def spans_of(spark, table, column):
    files = spark.table(table).groupBy(F.input_file_name().alias("f")).agg(
        F.min(column).alias("lo"), F.max(column).alias("hi"), F.count("*").alias("n")
    )
    return files.orderBy("lo", "hi").collect()


@pytest.fixture
def home(spark, tmp_path):
    name = f"sink_{tmp_path.name}".replace("-", "_")
    spark.sql(f"create namespace {name} location '{tmp_path}/{name}'")
    return name


def sizes_of(spark, table):
    path = sink._location(spark, table)
    return [r.length for r in spark.read.format("binaryFile").load(path).select("length").collect()]


@pytest.mark.parametrize(("sort_by", "unique_key"), [("at", False), ("number", False), ("name", False), ("pk_x", True)])
def test_sorted_tables_read_their_source_once(spark, home, sort_by, unique_key):
    rows = spark.range(0, 20_000, 1, 6).selectExpr(
        "timestamp_seconds(1700000000 + id * 7919 % 20000) as at",
        "cast(id * 7919 % 20000 as decimal(18,4)) / 8 as number",
        "concat('common-', lpad(id * 7919 % 20000, 6, '0')) as name",
        "md5(cast(id as string)) as pk_x",
    )
    rows, read = counting(spark, rows)
    table = sink.write_layer(rows, "raw", "t", sort_by, "test", home, unique_key, target_bytes=50_000)
    assert read.value == 20_000
    spans = spans_of(spark, table, sort_by)
    assert len(spans) > 8 and sum(s.n for s in spans) == 20_000
    assert all(a.hi < b.lo for a, b in zip(spans, spans[1:], strict=False))
    assert spark.table(table).exceptAll(rows).isEmpty()


@pytest.mark.parametrize("files", [1, 1000])
def test_files_are_near_the_target_size(spark, home, files):
    """Bytes that do not shrink, so that staged and final sizes agree."""
    rows = spark.range(0, 40_000, 1, 8).selectExpr("id * 7919 % 40000 as at", "unhex(concat(sha2(cast(id as string), 512), sha2(cast(-id as string), 512), repeat(sha2(cast(id + 0.5 as string), 512), 3))) as body")
    rows = rows.selectExpr("at", "body", *[f"unhex(sha2(concat(at, '-{k}'), 512)) as b{k}" for k in range(6)])
    total = sum(sizes_of(spark, sink.write_layer(rows, "raw", "whole", "at", "test", home)))
    table = sink.write_layer(rows, "raw", "t", "at", "test", home, target_bytes=total // files)
    sizes = sizes_of(spark, table)
    assert len(sizes) == pytest.approx(files, rel=0.1)
    assert all(total / files / 2 <= size <= 2 * total / files for size in sizes)


@pytest.mark.parametrize("other", ["id", "'a copy'"])
def test_sort_order_splits_a_value_many_rows_share(spark, other):
    df = spark.range(0, 4000, 1, 16).selectExpr("if(id % 3 > 0, 7, id) as at", f"{other} as other")
    laid = sink.in_sort_order(df, "at", 8).withColumn("_p", F.spark_partition_id())
    parts = laid.groupBy("_p").agg(F.min("at").alias("lo"), F.max("at").alias("hi"), F.count("*").alias("n")).orderBy("_p").collect()
    assert sum(p.n for p in parts) == 4000
    assert all(a.hi <= b.lo for a, b in zip(parts, parts[1:], strict=False))
    assert sum(p.lo <= 7 <= p.hi for p in parts) >= 5 and max(p.n for p in parts) <= 2 * 500


def test_more_files_than_ranges(spark, monkeypatch):
    monkeypatch.setattr(sink, "MAX_POINTS", 10)
    laid = sink.in_sort_order(spark.range(20_000), "id", 40).withColumn("_p", F.spark_partition_id())
    parts = laid.groupBy("_p").agg(F.min("id").alias("lo"), F.count("*").alias("n")).orderBy("_p").collect()
    assert len(parts) == 40 and max(p.n for p in parts) <= 2 * 500


@pytest.mark.parametrize("values", ["cast(null as timestamp)", "if(id % 2 = 0, null, timestamp_seconds(id))", "double('nan')", "if(id % 4 = 0, null, id / 3)", "repeat('é', cast(id % 9 as int))", "array(id)", "id > 30", "''"])
def test_odd_sort_columns(spark, values):
    df = spark.range(200).selectExpr(f"{values} as x", "id")
    laid = sink.in_sort_order(df, "x", 5)
    assert sorted(r.id for r in laid.collect()) == list(range(200))
    assert sink.in_sort_order(df.limit(0), "x", 3).count() == 0


def test_a_failing_write_leaves_the_old_table(spark, home):
    good = spark.range(100).selectExpr("id", "md5(cast(id as string)) as pk_x")
    bad = spark.range(100).selectExpr("if(id = 77, raise_error('broken'), id) as id", "md5(cast(id as string)) as pk_x")
    for sort_by, unique, bucket in (("id", False, None), ("pk_x", True, None), (None, False, None), ("pk_x", True, "pk_x")):
        name = f"t_{sort_by}_{bucket}".lower()
        table = sink.write_layer(good, "raw", name, sort_by, "test", home, unique, bucket)
        files = set(spark.table(table).inputFiles())
        with pytest.raises(Exception, match="broken"):
            sink.write_layer(bad, "raw", name, sort_by, "test", home, unique, bucket)
        assert set(spark.table(table).inputFiles()) == files
        assert sorted(r.id for r in spark.table(table).collect()) == list(range(100))
    assert not [t.name for t in spark.catalog.listTables(home) if "__" in t.name]


def test_a_write_that_fails_when_the_rows_are_laid_out(spark, home, monkeypatch):
    """The rows are staged, then the second step breaks."""
    table = sink.write_layer(spark.range(10), "raw", "t", "id", "test", home)
    monkeypatch.setattr(sink, "in_sort_order", lambda df, by, files: df.selectExpr("if(id = 5, raise_error('late'), id) as id"))
    with pytest.raises(Exception, match="late"):
        sink.write_layer(spark.range(20), "raw", "t", "id", "test", home)
    assert spark.table(table).count() == 10


def test_replacing_swaps_files_and_keeps_no_old_ones(spark, home, tmp_path):
    for rows in (spark.range(10), spark.range(20), spark.range(5).withColumn("more", F.lit("x"))):
        table = sink.write_layer(rows, "raw", "t", "id", "test", home)
        assert spark.table(table).exceptAll(rows).isEmpty() and spark.table(table).count() == rows.count()
        assert spark.table(table).columns == rows.columns
    assert len(list((tmp_path / home).iterdir())) == 1
    spark.range(3).write.mode("overwrite").saveAsTable(f"{home}.managed")
    sink.replace_table(spark.range(4), f"{home}.managed")
    assert spark.table(f"{home}.managed").count() == 4


def test_tables_by_hash_of_a_key_join_without_a_shuffle(spark, small):
    from tests.test_plans import plan

    tables, home = Tables(spark, small), "colocated"
    for name in ("sat_binance_transaction", "calc_binance_transaction_accountbalance"):
        write_model(tables[name], name, "test", home, bucket_rows=500)
    read = [spark.table(f"{home}.{name}") for name in MODELS["fact_binance_transaction"].reads]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = marts.fact_binance_transaction(*read, "run")
        text = plan(joined)
        assert "SortMergeJoin" in text and "Exchange" not in text and "SelectedBucketsCount" in text
        assert joined.count() == tables["sat_binance_transaction"].count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_small_buckets_grow_instead_of_becoming_too_many():
    """Buckets of 2,000 rows were 131,072 for 252 million rows, more than Spark takes."""
    assert sink.buckets_for(252_000_000, 2_000) == sink.buckets_for(42_000_000, 2_000) == 256
    assert sink.buckets_for(100_000, 2_000) == 64
    assert sink.buckets_for(10**10) == sink.buckets_for(10**10, 2_000) == 4_096


def test_keys_of_hubs_are_checked_where_they_lie(spark, small):
    from tests.test_plans import plan

    tables, home = Tables(spark, small), "checked"
    hubs = [name for name in HUB_KEYS if MODELS[name].bucketed]
    assert len(hubs) == 9
    for name in ("hub_binance_trade", "hub_bybit_trade"):
        rows, key = tables[name], HUB_KEYS[name]
        spoiled = rows.unionByName(rows.limit(3)).unionByName(rows.limit(2).withColumn(key, F.lit(None).cast("string")))
        table = spark.table(write_model(spoiled, name, "test", home, bucket_rows=100))
        report = key_report({name: (table, key)})
        text = plan(report)
        assert "Exchange hashpartitioning" not in text and "SelectedBucketsCount" in text
        assert {(r.check_name, r.failures) for r in report.collect()} == {("unique", 3), ("not_null", 2)}
        assert len(table.inputFiles()) > 2


def test_every_hub_has_a_checked_key():
    assert len(HUB_KEYS) == 12 and all(key.startswith("pk_") for key in HUB_KEYS.values())
