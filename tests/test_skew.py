"""End-to-end extraction on skewed data, against the plain SQL in DuckDB.

A session holds a third of all participants, one participant holds 5,000
null-reason cancellations (above the lowered hot-copy threshold, so its
copies are spread), and one shirt option is chosen by most participants.
"""

import datetime as dt

import duckdb
from pyspark.sql import functions as F

import rollcall.operators.fanout as fanout
from rollcall.plans.extract import PARTICIPANT_COLUMNS, extract_participants
from rollcall.plans.oracle_sql import PARTICIPANTS
from rollcall.sources.schemas import OPERATIONAL

N, S = 12_000, 3_000


def _tables(spark):
    r = spark.range
    col, lit, when = F.col, F.lit, F.when
    t = {
        "eventcomplement": r(0, 10).select(col("id").alias("eventId"),
                                           when(col("id") < 5, lit("ASIA")).otherwise(lit("EUROPE")).alias("globalEvent")),
        "event": r(0, 10).select("id", F.concat(lit("E"), col("id").cast("string")).alias("title")),
        "eventticket": r(0, 100).select("id", (col("id") % 10).alias("eventId"),
                                        F.concat(lit("T"), col("id").cast("string")).alias("name")),
        "eventticketcomplement": r(0, 100).select(col("id").alias("ticketId"), lit("PROVA").alias("nameParsed"))
            .unionByName(r(0, 100, 7).select(col("id").alias("ticketId"), lit("BIS").alias("nameParsed"))),
        "eventticketbatch": r(0, 100).select("id", col("id").alias("ticketId")),
        "eventticketbatchprice": r(0, 100).select("id", (col("id") % 3).alias("typeId"), col("id").alias("ticketBatchId")),
        "eventticketbatchpricetype": r(0, 2).select("id", F.concat(lit("TIPO"), col("id").cast("string")).alias("name")),
        "checkouteventticketbatchprice": r(0, N).select("id", (col("id") % 100).alias("eventTicketBatchPriceId")),
        "checkoutparticipant": r(0, N).select(
            "id", when(col("id") % 3 == 0, lit(0)).otherwise(col("id") % S).alias("sessionId"),
            col("id").alias("checkoutEventTicketBatchPriceId"), lit("Ana").alias("name"),
            when(col("id") % 11 == 0, lit(None)).otherwise(lit("Lima")).alias("surname"),
            lit("a@x").alias("email"), lit("1").alias("phoneNumber"), col("id").cast("string").alias("cpf"),
            F.date_sub(lit(dt.date(2000, 1, 1)), (col("id") % 30000).cast("int")).alias("birthDate"),
            lit(None).cast("string").alias("coupon"), lit("T").alias("trackingCode"),
            lit(dt.datetime(1997, 1, 1)).cast("timestamp_ntz").alias("createdAt")),
        "checkoutsession": r(0, S).select(
            "id", when(col("id") % 5 == 4, lit("Pending")).otherwise(lit("Paid")).alias("status"),
            (lit(dt.datetime(1997, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(mins=col("id"))).alias("createdAt")),
        "checkoutpayment": r(0, S).select(col("id").alias("sessionId"), lit("Pix").alias("paymentOption"))
            .unionByName(r(0, 1).select(col("id").alias("sessionId"), lit("Boleto").alias("paymentOption"))),
        "checkoutsummary": r(0, S, 2).select(col("id").alias("sessionId"), (col("id") % 4 == 0).cast("int").alias("ticketInsurance")),
        "checkoutorderticketpartialcancel": r(0, 5000).select(lit(1).alias("participantId"), lit(None).cast("string").alias("reason"))
            .unionByName(r(0, 300).select((col("id") * 7).alias("participantId"),
                                          when(col("id") % 2 == 0, lit("x")).alias("reason"))),
        "tradecheckoutsession": r(0, 400).select((col("id") * 5).alias("participantId"),
                                                 (col("id") * 5 + 1).alias("originalParticipantId"),
                                                 when(col("id") % 3 == 0, lit("Paid")).otherwise(lit("Pending")).alias("status"),
                                                 lit(1).cast("decimal(18,2)").alias("transferValue"),
                                                 lit("Novo").alias("participantName"), lit("Dono").alias("participantSurname")),
        "participant_options": r(0, N).select("id", F.array(lit(0), (col("id") % 40) + 1).alias("questionIDs")),
        "eventticketstockitems": r(0, 41).select("id", (col("id") % 4).alias("ticketStockId")),
        "eventticketstockitemscomplement": r(0, 41).select(col("id").alias("stockitemsid"),
                                                           F.concat(lit("S"), col("id").cast("string")).alias("nameParsed"),
                                                           lit("sab").alias("day"), lit("10h").alias("hour")),
        "eventticketstock": spark.createDataFrame([(0, "Tamanho da Camisa"), (1, "Shirt Size"), (2, "Kit Pickup"),
                                                   (3, "Outro")], "id long, name string"),
    }
    return {n: df.select([F.col(f.name).cast(f.dataType) for f in OPERATIONAL[n].fields]) for n, df in t.items()}


def test_skewed_extraction_matches_sql(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fanout, "CHUNK_COPIES", 1000)
    base = str(tmp_path / "ops")
    written = _tables(spark)
    for name, df in written.items():
        df.write.parquet(f"{base}/{name}")
    tables = {n: spark.read.schema(OPERATIONAL[n]).parquet(f"{base}/{n}") for n in written}
    got = extract_participants(tables, "ASIA", "1996-01-01", "1999-12-31", rows_per_batch=2500,
                               as_of=dt.date(2025, 6, 30), excluded_events=(7,))
    con = duckdb.connect()
    for n in written:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{base}/{n}/*.parquet')")
    con.execute("CREATE VIEW checkoutparticipant_array_vw AS "
                "SELECT id, unnest(questionIDs) AS questionIDs FROM participant_options")
    want = con.execute(f"WITH {PARTICIPANTS} SELECT {', '.join(PARTICIPANT_COLUMNS)} FROM participants").fetchall()
    rows = [tuple(r) for r in got.select(*PARTICIPANT_COLUMNS).collect()]
    assert len(rows) == len(want) > N
    assert sorted(map(repr, rows)) == sorted(map(repr, want))
    hot = [r for r in rows if r[1] == 1]
    assert len(hot) == 5000          # one copy per null-reason cancellation


def test_no_task_holds_a_hot_key_before_numbering(spark, tmp_path, monkeypatch):
    """A session with a third of the participants, a participant with most of the repeats."""
    import rollcall.plans.extract as extract
    spread = {}

    def before(df, *args, **kwargs):
        spread["sizes"] = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        return df.withColumn("batch_number", F.lit(1).cast("long"))
    monkeypatch.setattr(extract, "number_batches", before)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.shuffle.partitions": "16",
                # a skewed partition is split between map tasks: one a file, as files of full size have
                "spark.sql.files.openCostInBytes": "128m"}
    base = str(tmp_path / "ops")
    written = _tables(spark)
    people = written["tradecheckoutsession"]
    # one participant with 20,000 trades of which none is paid
    written["tradecheckoutsession"] = people.unionByName(spark.range(0, 20_000).select(
        F.lit(3).cast("long").alias("participantId"), F.col("id").alias("originalParticipantId"), F.lit("Pending").alias("status"),
        F.lit(1).cast("decimal(18,2)").alias("transferValue"), F.lit("Novo").alias("participantName"),
        F.lit("Dono").alias("participantSurname")).select(people.columns))
    for name, df in written.items():
        df.repartition(8).write.parquet(f"{base}/{name}")
    tables = {n: spark.read.schema(OPERATIONAL[n]).parquet(f"{base}/{n}") for n in written}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        extract_participants(tables, "ASIA", "1996-01-01", "1999-12-31", as_of=dt.date(2025, 6, 30), excluded_events=())
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(spread["sizes"]) > 20_000
    assert max(spread["sizes"]) < 0.25 * sum(spread["sizes"])
