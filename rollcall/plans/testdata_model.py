"""The driver's TPC-H-like tables seen as the ticketing data model.

Every operational table is a projection of a driver table (so its size grows
with the scale factor); ``TESTDATA_MODEL_SQL`` holds the same definitions in
DuckDB SQL for the oracle queries.  Mapping:

* editions: ``region`` names; events: ``nation``; tickets, batches, prices:
  ``customer`` (ticket -> event = customer -> nation);
* participants, sessions, checkout prices, payments, summaries, form answers:
  ``orders`` (one participant and one session per order);
* partial cancellations: ``lineitem`` rows with ``l_quantity > 45`` (a return
  flag ``R`` is a real reason, the rest have none);
* trades: ``events`` (two per participant id ``event_id div 2``, paid when the
  event is a purchase);
* chosen options: ``lineitem`` parts; option items and stock: ``part`` (stock
  = ``p_size``; sizes 1-2 are shirts, 3-4 kit pickup).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.sources.schemas import DRIVER, OPERATIONAL

# Postal answers by order priority: well formed, underscores, short, long,
# without hyphen (or missing for pending orders); F/O/P statuses spell the
# field id differently (case, accent) to exercise the collated join.
PRIORITY_ANSWER_SQL = """
  CASE o_orderpriority
    WHEN '1-URGENT' THEN substr(lpad(CAST(o_orderkey AS STRING), 8, '0'), 1, 5) || '-' ||
                         substr(lpad(CAST(o_orderkey AS STRING), 8, '0'), 6, 3)
    WHEN '2-HIGH' THEN replace(substr(lpad(CAST(o_orderkey AS STRING), 8, '0'), 1, 5) || '-' ||
                               substr(lpad(CAST(o_orderkey AS STRING), 8, '0'), 6, 3), '0', '_')
    WHEN '3-MEDIUM' THEN CAST(o_orderkey AS STRING)
    WHEN '4-NOT SPECIFIED' THEN substr(lpad(CAST(o_orderkey AS STRING), 8, '0'), 1, 5) || '-' ||
                                substr(lpad(CAST(o_orderkey AS STRING), 8, '0'), 6, 3) ||
                                CAST(o_custkey AS STRING)
    ELSE CASE WHEN o_orderstatus = 'P' THEN NULL ELSE lpad(CAST(o_orderkey AS STRING), 8, '0') END
  END"""


def postal_answer() -> "F.Column":
    return F.expr(PRIORITY_ANSWER_SQL)


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table with its declared schema (no footer-reading inference job)."""
    return spark.read.schema(DRIVER[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_read = read_driver_table


def _conform(df: DataFrame, name: str) -> DataFrame:
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in OPERATIONAL[name].fields])


def _hours(col: str, n: int):
    return F.col(col) + F.make_dt_interval(hours=F.lit(n))


def operational_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    region, nation = _read(spark, sf_dir, "region"), _read(spark, sf_dir, "nation")
    customer, orders = _read(spark, sf_dir, "customer"), _read(spark, sf_dir, "orders")
    lineitem, part, events = (_read(spark, sf_dir, n) for n in ("lineitem", "part", "events"))
    t: dict[str, DataFrame] = {}
    t["eventcomplement"] = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("eventId"), F.col("r_name").alias("globalEvent"))
    t["event"] = nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("title"))
    t["eventticket"] = customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("eventId"),
                                       F.col("c_mktsegment").alias("name"))
    t["eventticketcomplement"] = customer.filter(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").alias("ticketId"),
        F.concat(F.col("c_mktsegment"), F.lit(" "), F.col("c_nationkey").cast("string")).alias("nameParsed")
    ).unionByName(customer.filter(F.col("c_acctbal") > 9000).select(
        F.col("c_custkey").alias("ticketId"), F.lit("ELITE").alias("nameParsed")))
    t["eventticketbatch"] = customer.select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("ticketId"))
    t["eventticketbatchprice"] = customer.select(F.col("c_custkey").alias("id"),
                                                 F.col("c_nationkey").alias("typeId"),
                                                 F.col("c_custkey").alias("ticketBatchId"))
    t["eventticketbatchpricetype"] = region.select(
        F.col("r_regionkey").alias("id"), F.concat(F.lit("TIPO "), F.col("r_name")).alias("name"))
    t["checkouteventticketbatchprice"] = orders.select(F.col("o_orderkey").alias("id"),
                                                       F.col("o_custkey").alias("eventTicketBatchPriceId"))
    t["checkoutparticipant"] = orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("sessionId"),
        F.col("o_orderkey").alias("checkoutEventTicketBatchPriceId"),
        F.col("o_orderpriority").alias("name"), F.nullif(F.col("o_orderstatus"), F.lit("O")).alias("surname"),
        F.concat(F.lit("p"), F.col("o_orderkey").cast("string"), F.lit("@mail.test")).alias("email"),
        F.col("o_custkey").cast("string").alias("phoneNumber"),
        F.lpad(F.col("o_orderkey").cast("string"), 11, "0").alias("cpf"),
        F.date_sub(F.col("o_orderdate").cast("date"), F.floor(F.col("o_totalprice") / 20).cast("int"))
         .alias("birthDate"),
        F.when(F.col("o_totalprice") > 300000, F.concat(F.lit("CUPOM"), F.col("o_custkey").cast("string")))
         .alias("coupon"),
        F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("trackingCode"),
        _hours("o_orderdate", 2).alias("createdAt"))
    t["checkoutsession"] = orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("Pending")).otherwise(F.lit("Paid")).alias("status"),
        _hours("o_orderdate", 4).alias("createdAt"))
    t["checkoutpayment"] = orders.filter(F.col("o_orderpriority") != "5-LOW").select(
        F.col("o_orderkey").alias("sessionId"),
        F.expr("CASE o_orderpriority WHEN '1-URGENT' THEN 'Boleto' WHEN '2-HIGH' THEN 'CreditCard' "
               "WHEN '3-MEDIUM' THEN 'Pix' ELSE 'Voucher' END").alias("paymentOption")
    ).unionByName(orders.filter(F.col("o_totalprice") > 400000).select(
        F.col("o_orderkey").alias("sessionId"), F.lit("Pix").alias("paymentOption")))
    t["checkoutsummary"] = orders.filter(F.col("o_orderpriority") != "4-NOT SPECIFIED").select(
        F.col("o_orderkey").alias("sessionId"),
        F.when(F.col("o_totalprice") > 150000, 1).otherwise(0).alias("ticketInsurance"))
    t["checkoutorderticketpartialcancel"] = lineitem.filter(F.col("l_quantity") > 45).select(
        F.col("l_orderkey").alias("participantId"),
        F.when(F.col("l_returnflag") == "R", F.lit("devolvido")).alias("reason"))
    t["tradecheckoutsession"] = events.select(
        F.expr("event_id div 2").alias("participantId"), F.expr("event_id div 2 + 7").alias("originalParticipantId"),
        F.when(F.col("event_type") == "purchase", F.lit("Paid")).otherwise(F.lit("Pending")).alias("status"),
        F.col("value").cast(T.DecimalType(18, 2)).alias("transferValue"),
        F.col("event_type").alias("participantName"),
        F.nullif(F.col("user_id").cast("string"), F.lit("0")).alias("participantSurname"))
    t["participant_options"] = lineitem.select(F.col("l_orderkey").alias("id"),
                                               F.array(F.col("l_partkey")).alias("questionIDs"))
    t["eventticketstockitems"] = part.select(F.col("p_partkey").alias("id"), F.col("p_size").alias("ticketStockId"))
    t["eventticketstock"] = part.select(F.col("p_size").alias("id")).distinct().select(
        "id", F.expr("CASE id WHEN 1 THEN 'Tamanho da Camisa' WHEN 2 THEN 'Shirt Size' "
                     "WHEN 3 THEN 'Retirada de Kit' WHEN 4 THEN 'Kit Pickup' "
                     "ELSE 'Outro ' || CAST(id AS STRING) END").alias("name"))
    t["eventticketstockitemscomplement"] = part.filter(F.col("p_retailprice") < 990).select(
        F.col("p_partkey").alias("stockitemsid"), F.col("p_name").alias("nameParsed"),
        F.col("p_type").alias("day"), F.col("p_brand").alias("hour"))
    t["formfieldanswer"] = orders.select(
        F.col("o_orderkey").alias("checkoutParticipantId"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'CAMPO-CEP' WHEN 'O' THEN 'campo-cep' ELSE 'Campo-Cép' END")
         .alias("fieldId"),
        postal_answer().alias("answer")
    ).unionByName(orders.select(F.col("o_orderkey").alias("checkoutParticipantId"),
                                F.lit("camisa").alias("fieldId"), F.lit("M").alias("answer")))
    t["formFieldsPlaceholderParsed"] = region.select(
        F.when(F.col("r_regionkey") == 0, F.lit("campo-cep")).otherwise(
            F.concat(F.lit("campo-"), F.lower(F.col("r_name")))).alias("fieldId"),
        F.concat(F.lit("Pergunta "), F.col("r_name")).alias("placeholder"),
        F.when(F.col("r_regionkey") == 0, F.lit("CEP")).otherwise(F.lit("OUTRO")).alias("placeholderParsed"))
    return {name: _conform(df, name) for name, df in t.items()}


# Response bodies per normalised code: the last digit picks the answer shape of
# each provider, and every code also has an older, rejected answer from the
# first provider that the latest one must replace.
_BODY_FULL = ("'{\"cep\":\"' || c || '\",\"state\":\"UF' || substr(c, 1, 1) || "
              "'\",\"city\":\"Cidade ' || substr(c, 1, 3) || '\",\"neighborhood\":\"Bairro ' || "
              "substr(c, 4, 2) || '\",\"street\":\"Rua ' || substr(c, 7, 3) || '\",\"service\":\"' || p || '\"}'")
RESPONSE_BODY_SQL = f"""
  CASE p
    WHEN 'brasilapi' THEN CASE
      WHEN d IN ('0', '1', '2') THEN {_BODY_FULL}
      WHEN d = '3' THEN '{{"cep":null}}'
      WHEN d = '4' THEN '{{"errors":[]}}'
      WHEN d = '5' THEN '<html>'
      WHEN d = '6' THEN '[1]' END
    WHEN 'viacep' THEN CASE
      WHEN d IN ('3', '4', '5') THEN {_BODY_FULL}
      WHEN d = '6' THEN '{{"type":"validation_error"}}'
      WHEN d = '7' THEN '{{}}' END
    ELSE CASE
      WHEN d IN ('6', '7') THEN {_BODY_FULL}
      WHEN d = '8' THEN '{{"code":"not_found"}}' END
  END"""
STALE_BODY = '{"errors":["stale"]}'
UNUSED_BODY = '{"cep":"0"}'


def landed_responses(codes: DataFrame, code_col: str = "parsed_ceps") -> DataFrame:
    """Provider answers for the distinct codes of ``codes``, as a landing would hold them.

    The landing also holds, for each, an accepted answer to another code that no row uses.
    """
    from rollcall.operators.lookup import PROVIDER_ORDER
    distinct = codes.select(F.col(code_col).alias("c")).distinct().withColumn("d", F.substring("c", 9, 1))
    providers = F.explode(F.array(*[F.lit(p) for p in PROVIDER_ORDER])).alias("p")
    fresh = (distinct.select("c", "d", providers)
             .select(F.col("p").alias("provider"), F.col("c").alias("cep_requested"),
                     F.expr(RESPONSE_BODY_SQL).alias("body"),
                     F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("fetched_at"))
             .filter(F.col("body").isNotNull()))
    stale = distinct.select(F.lit(PROVIDER_ORDER[0]).alias("provider"), F.col("c").alias("cep_requested"),
                            F.lit(STALE_BODY).alias("body"),
                            F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("fetched_at"))
    unused = distinct.select(F.lit(PROVIDER_ORDER[0]).alias("provider"), F.concat(F.lit("X"), "c").alias("cep_requested"),
                             F.lit(UNUSED_BODY).alias("body"),
                             F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("fetched_at"))
    return fresh.unionByName(stale).unionByName(unused)
