"""Check queries by inventory id: the Spark job and, where SQL can say it, the oracle."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, MapType, TimestampType, VariantType

from driver_checks import oracle as O
from driver_checks import sources as S
from driver_checks.derived import AS_OF, AS_OF_SQL
from watchtide.functions.severity import severity_level_flat
from watchtide.functions.text import contains, first_text, has, starts_with
from watchtide.functions.variant import canonical_json, nullable_text, part
from watchtide.operators import base as base_view
from watchtide.operators import database, identity, kubernetes, malware, network, parity, quality, sessions, storage
from watchtide.operators.geo import GeoRanges
from watchtide.operators.newest import newest_per_key
from watchtide.plans import hunting, reports, sketches
from watchtide.settings import Settings, settings_table
from watchtide.sources import batches, contracts, exports, table as tables
from watchtide.storage import work_folder
from watchtide.streaming import archive, ingest, latest, monitors, unique

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Columns that carry whole documents or the time of the run.
UNCOMPARED = {"AdditionalFields", "ParsingTimestamp", "RawFinding", "ResourceDetails", "ServiceDetails"}


def plain(df: DataFrame) -> DataFrame:
    """``df`` with unzoned timestamps and lists as text, without documents."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if field.name in UNCOMPARED or isinstance(field.dataType, VariantType):
            continue
        if isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, ArrayType):
            column = F.array_join(column, "; ")
        elif isinstance(field.dataType, MapType):
            column = F.to_json(column)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def check(name: str, oracle: str | None = None):
    def register(query: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(query(spark, sf_dir))
        if oracle is not None:
            ORACLE[name] = oracle
        return query

    return register


def network_of(spark, sf, lookback="30d", geo=None):
    return network.network_findings(S.base(spark, sf, lookback, network.READS), geo)


def sessions_of(spark, sf, lookback="30d", compliant_only=True):
    return sessions.network_sessions(network_of(spark, sf, lookback), compliant_only)


def identity_of(spark, sf, lookback="30d"):
    return identity.identity_findings(S.base(spark, sf, lookback, identity.READS))


def storage_of(spark, sf, lookback="30d"):
    return storage.storage_findings(S.base(spark, sf, lookback, storage.READS))


def kubernetes_of(spark, sf, lookback="30d"):
    return kubernetes.kubernetes_findings(S.base(spark, sf, lookback, kubernetes.READS))


# ---- A: sources and sinks

EXPORTED = O.with_table(
    "SELECT Id, ActivityType, Arn, CAST(NULL AS VARCHAR) AS contract_error FROM t"
)


def _identified(df: DataFrame) -> DataFrame:
    event = F.col("event")
    return df.select(
        nullable_text(event, ".id").alias("Id"),
        nullable_text(event, ".type").alias("ActivityType"),
        nullable_text(event, ".arn").alias("Arn"),
        "contract_error",
    )


@check("a1_read_export", EXPORTED)
def _(spark, sf):
    return _identified(exports.read_findings(spark, S.finding_export(spark, sf)))


def _streamed(spark, sf, **options) -> DataFrame:
    out = work_folder(spark, "streamed")
    lines = exports.stream_findings(spark, S.finding_export(spark, sf), glob="*.txt.gz", **options)
    (
        _identified(lines)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", work_folder(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(out)


@check("a2_stream_export", EXPORTED)
def _(spark, sf):
    return _streamed(spark, sf)


@check("g7_bounded_trigger", EXPORTED)
def _(spark, sf):
    return _streamed(spark, sf, max_files=3)


@check(
    "a3_explode_batches",
    f"WITH {O.TABLE}, mixed AS (SELECT * FROM t UNION ALL SELECT * FROM t WHERE e % 12 = 2) SELECT "
    f"CASE WHEN e % 12 IN (2, 8, 9, 10, 11) THEN Arn END AS Arn, {O.BATCH_ERROR} AS contract_error FROM mixed",
)
def _(spark, sf):
    rows = exports.explode_batches(exports.read_findings(spark, S.mixed_export(spark, sf)))
    return rows.select(nullable_text(F.col("event"), ".arn").alias("Arn"), "contract_error")


@check(
    "a4_unwrap_events",
    f"WITH {O.TABLE}, mixed AS (SELECT * FROM t UNION ALL SELECT * FROM t WHERE e % 12 = 2) SELECT "
    f"CASE WHEN e % 12 IN (0, 1, 2, 8, 9, 10, 11) THEN Arn END AS Arn, {O.EVENT_ERROR} AS contract_error FROM mixed",
)
def _(spark, sf):
    lines = exports.read_findings(spark, S.mixed_export(spark, sf))
    rows = exports.unwrap_events(exports.explode_batches(lines))
    return rows.select(nullable_text(F.col("finding"), ".arn").alias("Arn"), "contract_error")


@check(
    "a5_a6_table_round_trip",
    O.with_table(
        "SELECT AccountId, ActivityType, Arn, Description, Id, PartitionName AS \"Partition\", Region, SchemaVersion, "
        "SeverityInt AS Severity, TimeCreated, TimeGenerated, Title FROM t "
        f"WHERE TimeGenerated >= {AS_OF_SQL} - INTERVAL '7' DAY"
    ),
)
def _(spark, sf):
    path = work_folder(spark, "round-trip")
    tables.write_findings(S.table(spark, sf), path)
    return base_view.recent(tables.findings(spark, path, "7d", AS_OF), "7d", AS_OF)


@check(
    "a7_map_table",
    O.with_table(
        "SELECT AccountId, ActivityType, Arn, Description, Id, PartitionName AS \"Partition\", Region, SchemaVersion, "
        "SeverityInt AS Severity, TimeCreated, TimeGenerated, Title, COALESCE(rtype, '') AS ResourceType, "
        "CASE WHEN has_service THEN detector_id ELSE '' END AS DetectorId, has_service AS HasService FROM t"
    ),
)
def _(spark, sf):
    mapped = tables.to_findings_table(S.unwrapped(spark, sf))
    return mapped.withColumns(
        {
            "ResourceType": F.coalesce(nullable_text(F.col("ResourceDetails"), ".resourceType"), F.lit("")),
            "DetectorId": F.coalesce(nullable_text(F.col("ServiceDetails"), ".detectorId"), F.lit("")),
            "HasService": F.to_json("ServiceDetails") != "{}",
        }
    )


def _flat(place: str, value: str) -> str:
    return O.at(place, value)


@check(
    "a8_flat_record",
    O.with_table(
        "SELECT "
        + O.columns(
            TimeGenerated="TimeGenerated",
            FindingId="Id",
            FindingType="ActivityType",
            Severity="severity",
            SeverityLevel=O.FLAT_LEVEL,
            Title="title",
            Description="description",
            AwsAccountId="AccountId",
            AwsRegion="CASE WHEN Region = '' THEN 'us-east-1' ELSE Region END",
            SchemaVersion="SchemaVersion",
            ResourceType="rtype",
            ActionType="atype",
            RemoteIp=f"CASE WHEN {O.CONDITIONS['net']} THEN remote_ip WHEN {O.CONDITIONS['call']} THEN call_ip END",
            RemoteCountry=f"CASE WHEN {O.CONDITIONS['net']} OR {O.CONDITIONS['call']} THEN remote_country END",
            Protocol=_flat("net", "protocol"),
            ConnectionDirection=_flat("net", "direction"),
            RemotePort=f"CAST({_flat('net', 'remote_port')} AS INTEGER)",
            LocalPort=f"CAST({_flat('net', 'local_port')} AS INTEGER)",
            ApiName=_flat("api", "api"),
            CallerType=_flat("api", "caller_type"),
            UserName=_flat("key", "key_user"),
            UserType=_flat("key", "key_user_type"),
            AccessKeyId=_flat("key", "key_id"),
            InstanceId=_flat("inst", "instance_id"),
            InstanceType=_flat("inst", "instance_type"),
            VpcId=_flat("iface", "vpc_id"),
            DetectorId="CASE WHEN has_service THEN detector_id END",
            EventFirstSeen="CAST(NULL AS VARCHAR)",
            EventLastSeen="CAST(NULL AS VARCHAR)",
        )
        + " FROM t"
    ),
)
def _(spark, sf):
    return tables.to_flat_record(S.unwrapped(spark, sf), default_region="us-east-1")


@check(
    "a9_canonical_json",
    O.with_table(
        f"SELECT Arn, CASE WHEN {O.CONDITIONS['net']} THEN '{{' || concat_ws(',', '\"port\":' || "
        "CAST(remote_port AS VARCHAR), '\"portName\":\"' || remote_port_name || '\"') || '}' END AS RemotePortJson "
        "FROM t"
    ),
)
def _(spark, sf):
    port = part(F.col("finding"), ".service.action.networkConnectionAction.remotePortDetails")
    return S.unwrapped(spark, sf).select(
        nullable_text(F.col("finding"), ".arn").alias("Arn"), canonical_json(port).alias("RemotePortJson")
    )


@check(
    "a9_canonical_finding",
    O.with_table("SELECT Arn, true AS Parsed, true AS Sorted FROM t"),
)
def _(spark, sf):
    """The whole finding: its text parses to an equal text, and the top keys come sorted."""
    whole = canonical_json(F.col("finding"))
    again = canonical_json(F.try_parse_json(whole))
    keys = F.json_object_keys(whole)
    return S.unwrapped(spark, sf).select(
        nullable_text(F.col("finding"), ".arn").alias("Arn"),
        whole.eqNullSafe(again).alias("Parsed"),
        keys.eqNullSafe(F.array_sort(keys)).alias("Sorted"),
    )


BATCH_LIMITS = {"max_rows": 25, "max_bytes": 20_000}


@check(
    "a10_pack_batches",
    O.with_table("SELECT COUNT(*) AS records, true AS rows_bounded, true AS bytes_bounded, true AS bytes_exact FROM t"),
)
def _(spark, sf):
    packed = batches.pack_batches(S.table(spark, sf), **BATCH_LIMITS)
    array = F.concat(F.lit("["), F.array_join("records", ","), F.lit("]"))
    return packed.agg(
        F.sum("rows").alias("records"),
        (F.max("rows") <= BATCH_LIMITS["max_rows"]).alias("rows_bounded"),
        (F.max("bytes") <= BATCH_LIMITS["max_bytes"]).alias("bytes_bounded"),
        (F.count_if(F.octet_length(array) != F.col("bytes")) == 0).alias("bytes_exact"),
    )


@check(
    "a10_packed_records",
    O.with_table("SELECT Arn, COUNT(*) AS copies FROM t GROUP BY Arn"),
)
def _(spark, sf):
    table = S.table(spark, sf)
    shared = batches.tasks_per_lane(table.count(), 6)
    packed = batches.pack_batches(table, lanes=6, lane_tasks=shared, **BATCH_LIMITS)
    return (
        packed.select(F.explode("records").alias("record"))
        .groupBy(F.get_json_object("record", "$.Arn").alias("Arn"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )


@check(
    "a11_batch_summary",
    O.with_table("SELECT COUNT(*) AS records_sent, true AS enough_batches FROM t"),
)
def _(spark, sf):
    summary = batches.batch_summary(batches.pack_batches(S.table(spark, sf)))
    enough = F.col("batches_sent") * batches.MAX_ROWS >= F.col("records_sent")
    return summary.select("records_sent", enough.alias("enough_batches"))


# ---- B: contracts and quality


@check("b1_required_members", O.with_table(f"SELECT Arn, {O.MISSING} AS missing FROM t"))
def _(spark, sf):
    finding = F.col("finding")
    return S.unwrapped(spark, sf).select(
        nullable_text(finding, ".arn").alias("Arn"), contracts.missing_members(finding).alias("m")
    ).select("Arn", F.array_join("m", ", ").alias("missing"))


@check("b2_type_and_range", O.with_table(f"SELECT Arn, {O.FINDING_ERROR} AS contract_error FROM t"))
def _(spark, sf):
    finding = F.col("finding")
    return contracts.check_findings(S.unwrapped(spark, sf)).select(
        nullable_text(finding, ".arn").alias("Arn"), "contract_error"
    )


@check(
    "b3_quarantine",
    f"WITH {O.TABLE}, {O.MIXED} SELECT COALESCE(contract_error, 'valid') AS outcome, COUNT(*) AS n FROM checked GROUP BY 1",
)
def _(spark, sf):
    checked = ingest.checked_events(exports.read_findings(spark, S.mixed_export(spark, sf)))
    valid, quarantine = contracts.split(checked)
    outcomes = valid.select(F.lit("valid").alias("outcome")).unionByName(
        quarantine.select(F.col("contract_error").alias("outcome"))
    )
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


FINDING_RULES = {
    "createdAt:required": "created_at IS NULL",
    "severity:required": "severity IS NULL",
    "accountId:pattern": "account_id = ''",
    "id:minLength": "finding_id = ''",
    "region:minLength": "region = ''",
    "type:minLength": "activity_type = ''",
    "confidence:range": "confidence < 0 OR confidence > 100",
    "resource.resourceType:required": "rtype IS NULL",
    "schemaVersion:pattern": "schema_version NOT LIKE '2.%'",
    "severity:range": "severity < 0 OR severity > 10",
}


def _rule_counts(rules: dict[str, str], source: str = "t") -> str:
    parts = [
        f"SELECT '{rule}' AS rule, COUNT(*) AS violations FROM {source} WHERE {condition} HAVING COUNT(*) > 0"
        for rule, condition in rules.items()
    ]
    return O.with_table(" UNION ALL ".join(parts))


@check("b4_finding_contract", _rule_counts(FINDING_RULES))
def _(spark, sf):
    return contracts.violation_counts(contracts.finding_violations(S.unwrapped(spark, sf)))


@check(
    "b4_finding_violations",
    O.with_table(
        " UNION ALL ".join(f"SELECT Id AS id, '{r}' AS rule FROM t WHERE {c}" for r, c in FINDING_RULES.items())
    ),
)
def _(spark, sf):
    return contracts.finding_violations(S.unwrapped(spark, sf))


EVENT_RULES = {
    "version:const": "e % 5 = 0",
    "id:minLength": "e % 7 = 0",
    "detail-type:required": "e % 11 = 0",
    "source:const": "e % 13 = 0",
    "account:pattern": "e % 17 = 0",
    "time:date-time": "e % 19 = 0",
    "region:type": "e % 23 = 0",
    "resources:type": "e % 29 = 0",
    "resources.items:type": "e % 29 = 1",
    "detail:type": "e % 31 = 0",
    **{f"detail.{rule}": f"e % 31 <> 0 AND ({condition})" for rule, condition in FINDING_RULES.items()},
}


@check("b5_event_contract", _rule_counts(EVENT_RULES))
def _(spark, sf):
    e = F.col("e")

    def unless(step: int, good: str, bad: str):
        return F.when(e % step == 0, F.lit(bad)).otherwise(F.lit(good))

    members = F.concat_ws(
        ",",
        unless(5, '"version":"0"', '"version":0'),
        unless(7, '"id":"ev"', '"id":""'),
        F.when(e % 11 != 0, F.lit('"detail-type":"GuardDuty Finding"')),
        unless(13, '"source":"aws.guardduty"', '"source":"other"'),
        unless(17, '"account":"123456789012"', '"account":"12345"'),
        unless(19, '"time":"2024-01-01T00:00:00Z"', '"time":"yesterday"'),
        unless(23, '"region":"us-east-1"', '"region":7'),
        F.when(e % 29 == 1, F.lit('"resources":["a",1]')).otherwise(
            unless(29, '"resources":[]', '"resources":{}')
        ),
        F.when(e % 31 == 0, F.lit('"detail":[]')).otherwise(F.concat(F.lit('"detail":'), F.col("raw"))),
    )
    lines = S.finding_lines(spark, sf).select(F.concat(F.lit("{"), members, F.lit("}")).alias("raw"))
    return contracts.violation_counts(contracts.event_violations(exports.parse_lines(lines)))


@check("b7_quality_category", O.with_quality("SELECT * FROM quality"))
def _(spark, sf):
    return quality.quality_categories(S.table(spark, sf, "30d"), "30d", AS_OF)


@check(
    "b8_quality_score",
    O.with_base("SELECT Id AS FindingId, score AS DataQualityScore FROM b", gates=False),
)
def _(spark, sf):
    ungated = base_view.base_findings(S.table(spark, sf), "30d", AS_OF, Settings(data_validation=False))
    return ungated.select("FindingId", "DataQualityScore")


@check(
    "b9_version_gate",
    O.with_base("SELECT SchemaVersion, COUNT(*) AS Findings FROM b GROUP BY SchemaVersion"),
)
def _(spark, sf):
    return hunting.count_by(S.base(spark, sf), "SchemaVersion")


@check(
    "b10_identity_quality",
    O.with_identity("SELECT DataQuality, COUNT(*) AS Findings FROM identity GROUP BY 1"),
)
def _(spark, sf):
    return hunting.count_by(identity_of(spark, sf), "DataQuality")


COMPLIANCE = O.with_sessions("SELECT ASIMCompliance, COUNT(*) AS Findings FROM sessions GROUP BY 1")


@check("b11_session_compliance", COMPLIANCE.replace("GROUP BY 1", "WHERE ASIMCompliance = 'Compliant' GROUP BY 1"))
def _(spark, sf):
    return hunting.count_by(sessions_of(spark, sf), "ASIMCompliance")


# Sent findings: every copy, some with another severity or region, some ids that never arrived.
SENT = (
    "CASE WHEN h % 19 = 0 THEN Id || '-lost' ELSE Id END AS Id, AccountId, ActivityType AS Type, "
    "CASE WHEN h % 7 = 0 THEN 'elsewhere' ELSE Region END AS Region, "
    "CASE WHEN h % 5 = 0 THEN severity + 1 ELSE severity END AS Severity, TimeGenerated AS UpdatedAt, arn AS Arn"
)


# Stored copies from this day on belong to the delivery.
DELIVERY, DELIVERY_SQL = datetime(2024, 1, 12), "TIMESTAMP '2024-01-12 00:00:00'"


def _sent(spark, sf) -> DataFrame:
    mapped = S.attributes(spark, sf).select(
        "h",
        F.col("finding_id").alias("Id"),
        F.col("account_id").alias("AccountId"),
        F.col("activity_type").alias("ActivityType"),
        F.col("region").alias("Region"),
        F.col("severity").alias("Severity"),
        F.col("updated_at").alias("TimeGenerated"),
        "arn",
    )
    return mapped.selectExpr(
        "CASE WHEN h % 19 = 0 THEN Id || '-lost' ELSE Id END AS Id",
        "AccountId",
        "ActivityType AS Type",
        "CASE WHEN h % 7 = 0 THEN 'elsewhere' ELSE Region END AS Region",
        "CASE WHEN h % 5 = 0 THEN Severity + 1 ELSE Severity END AS Severity",
        "TimeGenerated AS UpdatedAt",
    )


def _field(name: str, expected: str, actual: str) -> str:
    return (
        f"SELECT Id, '{name}' AS field, {expected} AS expected, {actual} AS actual FROM both_sides "
        f"WHERE {expected} IS DISTINCT FROM {actual}"
    )


@check(
    "b12_parity",
    f"WITH {O.TABLE}, sent AS (SELECT {SENT} FROM t), "
    "ns AS (SELECT * FROM sent QUALIFY ROW_NUMBER() OVER (PARTITION BY Id ORDER BY UpdatedAt DESC) = 1), "
    f"near AS (SELECT * FROM t WHERE TimeGenerated >= {DELIVERY_SQL} AND Id IN (SELECT Id FROM sent)), na AS ({O.newest(None, 'near')}), both_sides AS (SELECT COALESCE(ns.Id, na.Id) AS Id, ns.AccountId AS ea, "
    "na.AccountId AS aa, ns.Type AS et, na.ActivityType AS atp, ns.Region AS er, na.Region AS ar, "
    "CAST(CAST(TRUNC(ns.Severity) AS INTEGER) AS VARCHAR) AS es, CAST(na.SeverityInt AS VARCHAR) AS acs "
    "FROM ns LEFT JOIN na ON ns.Id = na.Id) "
    + " UNION ALL ".join(
        [
            _field("AccountId", "ea", "aa"),
            _field("ActivityType", "et", "atp"),
            _field("Region", "er", "ar"),
            _field("Severity", "es", "acs"),
        ]
    ),
)
def _(spark, sf):
    return parity.parity_mismatches(_sent(spark, sf), _with_unsent(S.table(spark, sf)), DELIVERY)


def _with_unsent(table: DataFrame) -> DataFrame:
    """The table and as many findings that were never sent, which parity passes over."""
    return table.unionByName(table.withColumn("Id", F.concat("Id", F.lit("-unsent"))))


@check(
    "b13_missing_ids",
    f"WITH {O.TABLE}, sent AS (SELECT {SENT} FROM t) SELECT DISTINCT Id FROM sent WHERE Id NOT IN "
    f"(SELECT Id FROM t WHERE TimeGenerated >= {DELIVERY_SQL})",
)
def _(spark, sf):
    return parity.missing_ids(_sent(spark, sf), _with_unsent(S.table(spark, sf)), DELIVERY)


# ---- C: base view


@check("c1_base_view", O.with_base(O.BASE_SELECT))
def _(spark, sf):
    return S.base(spark, sf)


@check("c1_raw_json", O.with_base(f"SELECT Id AS FindingId, Arn, {O.RAW_JSON} AS Document FROM b"))
def _(spark, sf):
    """The whole finding as the base view renders it, of every newest copy."""
    base = S.base(spark, sf)
    return base.select("FindingId", F.get_json_object("RawJson", "$.arn").alias("Arn"), F.col("RawJson").alias("Document"))


@check(
    "a7_documents",
    O.with_table(f"SELECT Id, Arn, TimeGenerated, {O.RESOURCE_TEXT} AS Resource, {O.SERVICE_TEXT} AS Service FROM t"),
)
def _(spark, sf):
    """Both documents of every stored copy, whole."""
    table = S.table(spark, sf)
    return table.select("Id", "Arn", "TimeGenerated", F.to_json("ResourceDetails").alias("Resource"), F.to_json("ServiceDetails").alias("Service"))


@check("c1a_default_lookback", O.with_base(O.BASE_SELECT, "7"))
def _(spark, sf):
    return S.base(spark, sf, None)


@check("c1a_longest_lookback", O.with_base("SELECT Id AS FindingId, TimeGenerated FROM b", "90"))
def _(spark, sf):
    return base_view.stored_base(spark, S.table_path(spark, sf), "3650d", AS_OF).select("FindingId", "TimeGenerated")


@check("c1c_newest_per_id", f"WITH {O.TABLE} SELECT Id, Arn, TimeGenerated FROM ({O.newest(None)}) AS n")
def _(spark, sf):
    return newest_per_key(S.table(spark, sf)).select("Id", "Arn", "TimeGenerated")


EQUAL_TIMES = (
    f"WITH {O.TABLE}, twice AS (SELECT * FROM t UNION ALL SELECT * REPLACE (Title || ' again' AS Title) FROM t), "
    f"hashed AS (SELECT *, {O.CONTENT_HASH} AS ContentHash FROM twice) SELECT Id, Arn, Title, ContentHash FROM "
    f"({O.newest(None, 'hashed', 'ContentHash')}) AS n"
)


@check("c1c_equal_time_copies", EQUAL_TIMES)
def _(spark, sf):
    """Every copy comes twice, with equal times and other titles: the same one is kept in every run."""
    rows = S.table(spark, sf)
    twice = rows.unionByName(rows.withColumn("Title", F.concat("Title", F.lit(" again"))))
    return newest_per_key(tables.with_content_hash(twice)).select("Id", "Arn", "Title", "ContentHash")


@check(
    "c1d_finding_json",
    O.with_base(
        "SELECT Id AS id, Arn AS arn, ActivityType AS kind, CAST(SeverityInt AS VARCHAR) || '.0' AS severity, "
        "rtype AS resource_type, atype AS action_type, Title AS title FROM b"
    ),
)
def _(spark, sf):
    raw = F.col("RawJson")
    paths = {
        "id": "$.id",
        "arn": "$.arn",
        "kind": "$.type",
        "severity": "$.severity",
        "resource_type": "$.resource.resourceType",
        "action_type": "$.service.action.actionType",
        "title": "$.title",
    }
    return S.base(spark, sf).select(*[F.get_json_object(raw, p).alias(n) for n, p in paths.items()])


@check(
    "c2_flat_levels",
    O.with_table(f"SELECT severity AS Severity, {O.FLAT_LEVEL} AS SeverityLevel, COUNT(*) AS n FROM t GROUP BY 1, 2"),
)
def _(spark, sf):
    score = F.try_variant_get("finding", "$.severity", "double")
    scored = S.unwrapped(spark, sf).select(score.alias("Severity"))
    leveled = scored.withColumn("SeverityLevel", severity_level_flat(F.col("Severity")))
    return leveled.groupBy("Severity", "SeverityLevel").agg(F.count(F.lit(1)).alias("n"))


# ---- D: specialist views


@check("d1_network_view", O.with_network(f"SELECT * EXCLUDE (level), {O.NO_GEO} FROM network"))
def _(spark, sf):
    return network_of(spark, sf)


@check("d2_identity_view", O.with_identity("SELECT * FROM identity"))
def _(spark, sf):
    return identity_of(spark, sf)


@check("d3_storage_view", O.with_base("SELECT * FROM storage", more=",\n" + O.STORAGE))
def _(spark, sf):
    return storage_of(spark, sf)


@check("d4_kubernetes_view", O.with_base("SELECT * FROM kubernetes", more=",\n" + O.KUBERNETES))
def _(spark, sf):
    return kubernetes_of(spark, sf)


@check("d5_malware_view", O.with_base("SELECT * FROM malware", more=",\n" + O.MALWARE))
def _(spark, sf):
    return malware.malware_findings(S.base(spark, sf, reads=malware.READS))


@check("d6_database_view", O.with_base("SELECT * FROM databases", more=",\n" + O.DATABASE))
def _(spark, sf):
    return database.database_findings(S.base(spark, sf, reads=database.READS))


@check("d7_session_view", O.with_sessions("SELECT * FROM sessions WHERE ASIMCompliance = 'Compliant'"))
def _(spark, sf):
    return sessions_of(spark, sf)


EXTRA = (
    "AwsAccountId", "AwsRegion", "VpcId", "SubnetId", "InstanceId", "InstanceType", "SecurityGroupIds", "NetworkInterfaceId",
    "RemoteOrganization", "RemoteIsp", "RemoteAsn", "Platform", "ImageId", "LaunchTime",
)


@check(
    "d7_additional_fields",
    O.with_sessions(
        "SELECT n.FindingId, n.FindingId AS GuardDutyFindingId, "
        + ", ".join(f"n.{name}" if name == "LaunchTime" else f"CAST(n.{name} AS VARCHAR) AS {name}" for name in EXTRA)
        + " FROM network n WHERE RemoteIp <> '' AND Protocol <> ''"
    ),
)
def _(spark, sf):
    """Every member of the bag."""
    bag = F.col("AdditionalFields")
    return sessions_of(spark, sf).select(
        F.col("NetworkSessionId").alias("FindingId"), *[F.get_json_object(bag, "$." + n).alias(n) for n in ("GuardDutyFindingId", *EXTRA)]
    ).withColumn("LaunchTime", F.col("LaunchTime").cast("timestamp"))


@check("d1_shared_base", O.with_network("SELECT FindingId, ThreatCategory, NetworkRiskScore, SecurityGroupIds FROM network"))
def _(spark, sf):
    """The view over a base that carries whole documents, as when several views share one base."""
    shared = network.network_findings(S.base(spark, sf))
    return shared.select("FindingId", "ThreatCategory", "NetworkRiskScore", "SecurityGroupIds")


# ---- E: reports


@check(
    "e1_data_availability",
    O.with_table(
        "SELECT CASE WHEN COUNT(*) = 0 THEN 'FAIL: No GuardDuty records found' "
        f"WHEN MAX(TimeGenerated) < {AS_OF_SQL} - INTERVAL '24' HOUR THEN 'WARNING: Latest record is older than 24 hours' "
        "ELSE 'PASS: GuardDuty data is available' END AS TestResult, COUNT(*) AS RecordCount, "
        "MAX(TimeGenerated) AS LatestRecord, MIN(TimeGenerated) AS OldestRecord, "
        "(epoch_us(MAX(TimeGenerated)) - epoch_us(MIN(TimeGenerated))) / 1000000.0e0 AS DataSpanSeconds "
        f"FROM t WHERE TimeGenerated >= {AS_OF_SQL} - INTERVAL '7' DAY"
    ),
)
def _(spark, sf):
    return reports.data_availability(S.table(spark, sf, "7d"), as_of=AS_OF)


STRUCTURE = O.with_base(
    "SELECT CASE WHEN n = 0 THEN 'FAIL: No parseable GuardDuty records' WHEN s < 80 THEN "
    "'WARNING: Some records missing required fields' ELSE 'PASS: GuardDuty data structure is valid' END AS TestResult, "
    "n AS TotalRecords, s AS StructureScore, types AS UniqueFindingTypes, accounts AS UniqueAccounts FROM ("
    "SELECT COUNT(*) AS n, CAST((COUNT(*) FILTER (Id <> '') + COUNT(*) + COUNT(*) FILTER (AccountId <> '') + COUNT(*)) "
    "* 100 // NULLIF(COUNT(*) * 4, 0) AS BIGINT) AS s, COUNT(DISTINCT ActivityType) AS types, "
    "COUNT(DISTINCT AccountId) AS accounts FROM b) AS x",
    "1",
)


@check("e2_structure_score", STRUCTURE)
def _(spark, sf):
    return reports.structure_score(S.base(spark, sf, "1d"))


@check(
    "e3_type_diversity",
    O.with_base(
        "SELECT CASE WHEN COUNT(*) = 0 THEN 'FAIL: No finding types detected' WHEN COUNT(*) < 3 THEN "
        "'WARNING: Limited finding type diversity' ELSE 'PASS: Multiple GuardDuty finding types detected' END AS TestResult, "
        "COUNT(*) AS TotalTypes, string_agg(kind || ' (' || n || ')', '; ' ORDER BY n DESC, kind) AS TopFindingTypes "
        "FROM (SELECT ActivityType AS kind, COUNT(*) AS n FROM b GROUP BY 1 ORDER BY n DESC, kind LIMIT 10) AS top",
        "7",
    ),
)
def _(spark, sf):
    return reports.type_diversity(S.base(spark, sf, "7d"))


@check(
    "e4_network_quality",
    O.with_network(
        "SELECT CASE WHEN n = 0 THEN 'INFO: No network findings in timeframe' WHEN ips * 100 // n < 50 THEN "
        "'WARNING: Many network findings missing IP details' ELSE 'PASS: Network findings have good data quality' END "
        "AS TestResult, n AS NetworkFindings, ips AS FindingsWithRemoteIP, "
        "uips AS UniqueRemoteIPs, ucs AS UniqueCountries FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (RemoteIp <> '') "
        "AS ips, COUNT(RemotePort) AS ports, COUNT(DISTINCT RemoteIp) AS uips, COUNT(DISTINCT RemoteCountry) AS ucs "
        "FROM network) AS x",
        "7",
    ),
)
def _(spark, sf):
    return reports.network_quality(network_of(spark, sf, "7d"))


@check(
    "e5_identity_quality",
    O.with_identity(
        "SELECT CASE WHEN n = 0 THEN 'INFO: No IAM findings in timeframe' WHEN apis * 100 // n < 50 THEN "
        "'WARNING: Many IAM findings missing API details' ELSE 'PASS: IAM findings have good data quality' END "
        "AS TestResult, n AS IAMFindings, apis AS FindingsWithAPI, users AS FindingsWithUser, uapis AS UniqueAPIs, "
        "uusers AS UniqueUsers FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (ApiName <> '') AS apis, "
        "COUNT(*) FILTER (UserName <> '') AS users, COUNT(DISTINCT ApiName) AS uapis, "
        "COUNT(DISTINCT UserName) AS uusers FROM identity) AS x",
        "7",
    ),
)
def _(spark, sf):
    return reports.identity_quality(identity_of(spark, sf, "7d"))


@check(
    "e6_ingestion_pattern",
    O.with_table(
        "SELECT CASE WHEN COUNT(*) = 0 THEN 'No data in last 24 hours' WHEN COUNT(*) < 12 THEN "
        "'Intermittent ingestion - possible KMS/permission issues' WHEN MIN(n) = 0 THEN "
        "'Gaps in ingestion - check connector health' ELSE 'Consistent ingestion pattern' END AS IngestionPattern, "
        "COUNT(*) AS HoursWithData, AVG(n) AS AvgRecordsPerHour, MAX(n) AS MaxRecordsPerHour "
        "FROM (SELECT date_trunc('hour', TimeGenerated) AS h, COUNT(*) AS n FROM t WHERE TimeGenerated >= "
        f"{AS_OF_SQL} - INTERVAL '7' DAY GROUP BY 1 ORDER BY 1 DESC LIMIT 24) AS bins"
    ),
)
def _(spark, sf):
    return reports.ingestion_pattern(S.table(spark, sf, "7d"), AS_OF)


def _rates(lost: str) -> str:
    return (
        "SELECT CASE WHEN r < 90 THEN 'JSON parsing issues - check raw data format' WHEN s < 80 THEN "
        "'Missing required fields - possible schema changes' ELSE 'Good data quality' END AS QualityAssessment, "
        f"n AS TotalRecords, r AS JsonParseRate, s AS DataQualityScore FROM (SELECT COUNT(*) AS n, "
        f"CAST(COUNT(*) * 100 // NULLIF(COUNT(*) + {lost}, 0) AS BIGINT) AS r, CAST((COUNT(*) FILTER (Id <> '') + COUNT(*) + "
        "COUNT(*) FILTER (AccountId <> '')) * 100 // NULLIF(COUNT(*) * 3, 0) AS BIGINT) AS s FROM b) AS x"
    )


@check("e7_data_quality_rates", O.with_base(_rates("0"), "1"))
def _(spark, sf):
    return reports.data_quality_rates(S.base(spark, sf, "1d"))


@check(
    "e7_parse_rates",
    O.with_base(_rates("(SELECT COUNT(*) FILTER (contract_error = 'line is not valid JSON') FROM checked)"), "30", more=f",\n{O.MIXED}"),
)
def _(spark, sf):
    """The rates of the whole month, with the lines of its delivery that are no JSON."""
    quarantine = spark.read.parquet(_committed(spark, sf)[1])
    return reports.data_quality_rates(S.base(spark, sf), quarantine.filter("contract_error = 'line is not valid JSON'"))


PAIRS = (
    "SELECT AccountId AS AwsAccountId, Region AS AwsRegion, COUNT(*) AS RecordCount, MIN(EventTime) AS FirstSeen, "
    "MAX(EventTime) AS LastSeen FROM b GROUP BY 1, 2 ORDER BY RecordCount DESC, 1, 2 LIMIT 20"
)


@check("e8_account_regions", O.with_base(PAIRS, "7"))
def _(spark, sf):
    return reports.account_region_pairs(S.base(spark, sf, "7d"))


@check(
    "e8_account_region_coverage",
    O.with_base(
        "SELECT 'Monitoring ' || COUNT(DISTINCT AwsAccountId) || ' accounts across ' || COUNT(DISTINCT AwsRegion) || "
        "' regions' AS Coverage, COUNT(DISTINCT AwsAccountId) AS UniqueAccounts, COUNT(DISTINCT AwsRegion) AS UniqueRegions, "
        "string_agg(AwsAccountId || '/' || AwsRegion || ' (' || RecordCount || ')', "
        f"'; ' ORDER BY RecordCount DESC, AwsAccountId, AwsRegion) AS TopAccountRegions FROM ({PAIRS}) AS pairs",
        "7",
    ),
)
def _(spark, sf):
    return reports.account_region_coverage(S.base(spark, sf, "7d"))


NOTES = ", ".join(f"'{words}' AS {name}" for name, words in reports.HEALTH_NOTES.items())
HEALTH = (
    "CASE WHEN COUNT(*) = 0 THEN 'No recent data - check connector' "
    f"WHEN MAX(TimeGenerated) < {AS_OF_SQL} - INTERVAL '2' HOUR THEN 'Data delay - possible ingestion lag' "
    "ELSE 'Healthy ingestion' END AS HealthStatus, COUNT(*) AS RecentRecords, MAX(TimeGenerated) AS LatestRecord, "
    "COUNT(DISTINCT Id) AS UniqueFindings"
)


def _last_hours(hours: str) -> str:
    """Base view of the last hours: the day view's SQL with the lookback in hours."""
    return O.with_base("{select}", "1").replace("INTERVAL '1' DAY", f"INTERVAL '{hours}' HOUR")


@check(
    "e9_recent_health",
    _last_hours("1").replace("{select}", f"SELECT {AS_OF_SQL} AS CheckTime, {NOTES}, {HEALTH} FROM b"),
)
def _(spark, sf):
    return reports.recent_health(S.base(spark, sf, "1h"), AS_OF)


@check(
    "e11_diagnostic_report",
    O.with_base(
        "SELECT '1. Connector Data Availability' AS Section, COUNT(*) AS RecordCount, MAX(TimeGenerated) AS LatestRecord, "
        "CAST(NULL AS BIGINT) AS ConfigEntries, CAST(NULL AS BIGINT) AS ParsedRecords, CAST(NULL AS BIGINT) AS "
        "UniqueFindings, CAST(NULL AS VARCHAR) AS SeverityDistribution FROM t UNION ALL "
        "SELECT '2. Parsing Function Status', NULL, NULL, 15, NULL, NULL, NULL UNION ALL "
        "SELECT '3. Data Quality Check', NULL, NULL, NULL, CAST(SUM(n) AS BIGINT), CAST(SUM(ids) AS BIGINT), "
        "'{' || string_agg('\"' || level || '\":' || n, ',' ORDER BY level) || '}' FROM (SELECT level, COUNT(*) AS n, "
        "COUNT(DISTINCT Id) AS ids FROM b GROUP BY level) AS levels",
        "1",
    ),
)
def _(spark, sf):
    return reports.diagnostic_report(S.table(spark, sf), settings_table(spark), S.base(spark, sf, "1d"))


SMOKE_TESTS = {
    "Data Availability": "e1_data_availability",
    "Data Structure": "e2_structure_score",
    "Finding Types": "e3_type_diversity",
    "Network Findings": "e4_network_quality",
    "IAM Findings": "e5_identity_quality",
}


# What the metrics of each smoke test hold: times, a list as text, numbers.
SMOKE_METRICS = {
    "e1_data_availability": ("RecordCount", "LatestRecord", "OldestRecord", "DataSpanSeconds"),
    "e2_structure_score": ("TotalRecords", "StructureScore", "UniqueFindingTypes", "UniqueAccounts"),
    "e3_type_diversity": ("TotalTypes", "TopFindingTypes"),
    "e4_network_quality": ("NetworkFindings", "FindingsWithRemoteIP", "UniqueRemoteIPs", "UniqueCountries"),
    "e5_identity_quality": ("IAMFindings", "FindingsWithAPI", "FindingsWithUser", "UniqueAPIs", "UniqueUsers"),
}


def _metrics_sql(key: str) -> str:
    def shown(name: str) -> str:
        if name in ("LatestRecord", "OldestRecord"):
            return O.json_time(name)
        if name == "TopFindingTypes":
            return f"'[\"' || replace({name}, '; ', '\",\"') || '\"]'"
        return f"CAST({name} AS VARCHAR)"

    return "'{' || " + " || ',' || ".join(f"'\"{n}\":' || COALESCE({shown(n)}, 'null')" for n in SMOKE_METRICS[key]) + " || '}'"


@check(
    "e12_smoke_suite",
    " UNION ALL ".join(
        f"SELECT '{test}' AS Test, TestResult, {_metrics_sql(key)} AS Metrics FROM ({ORACLE[key]}) AS {key}"
        for test, key in SMOKE_TESTS.items()
    ),
)
def _(spark, sf):
    return reports.smoke_suite(S.table(spark, sf, "7d"), AS_OF)


@check(
    "e13_data_lag",
    O.with_table(
        "SELECT COUNT(*) AS RecordCount, MAX(TimeGenerated) AS LatestRecord, "
        f"(epoch_us({AS_OF_SQL}) - epoch_us(MAX(TimeGenerated))) / 1000000.0e0 AS DataLagSeconds, CASE WHEN COUNT(*) = 0 "
        f"THEN 'No data - check KMS permissions' WHEN {AS_OF_SQL} - MAX(TimeGenerated) > INTERVAL '30' MINUTE THEN "
        "'Data lag detected' ELSE 'KMS permissions working' END AS Status FROM t "
        f"WHERE TimeGenerated > {AS_OF_SQL} - INTERVAL '1' HOUR"
    ),
)
def _(spark, sf):
    return reports.data_lag(S.table(spark, sf, "1h"), AS_OF)


# ---- F: documented user queries


@check(
    "f1_high_severity",
    O.with_base(
        f"SELECT EventTime, ActivityType AS FindingType, {O.text('title')} AS Title, AccountId AS AwsAccountId, "
        "Region AS AwsRegion FROM b WHERE level = 'High'",
        "1",
    ),
)
def _(spark, sf):
    return hunting.high_severity(S.base(spark, sf, "1d"))


@check(
    "f2_findings_by_country",
    O.with_network(
        "SELECT RemoteCountry, FindingType, COUNT(*) AS Findings FROM network WHERE RemoteIp <> '' GROUP BY 1, 2", "7"
    ),
)
def _(spark, sf):
    return hunting.findings_by_country(network_of(spark, sf, "7d"))


@check(
    "f3_exposed_buckets",
    O.with_base(
        "SELECT EventTime, BucketName, S3RiskCategory, EffectivePermission, EncryptionType, AwsAccountId FROM storage "
        "WHERE IsPubliclyExposed OR S3RiskCategory = 'Encryption Disabled'",
        "7",
        more=",\n" + O.STORAGE,
    ),
)
def _(spark, sf):
    return hunting.exposed_buckets(storage_of(spark, sf, "7d"))


@check(
    "f4_risky_workloads",
    O.with_base(
        "SELECT EventTime, ClusterName, K8sNamespace, K8sObjectName, K8sIsPrivileged, K8sRiskScore FROM kubernetes "
        "WHERE K8sThreatCategory IN ('Privilege Escalation', 'Credential Access')",
        "7",
        more=",\n" + O.KUBERNETES,
    ),
)
def _(spark, sf):
    return hunting.risky_workloads(kubernetes_of(spark, sf, "7d"))


@check(
    "f5_inbound_sessions",
    O.with_sessions(
        "SELECT TimeGenerated, SrcIpAddr, DstIpAddr, DstPortNumber, ThreatCategory FROM sessions "
        "WHERE NetworkDirection = 'Inbound' AND ASIMCompliance = 'Compliant'",
        "1",
    ),
)
def _(spark, sf):
    return hunting.inbound_sessions(sessions_of(spark, sf, "1d"))


@check(
    "f6_severity_levels",
    O.with_base("SELECT level AS SeverityLevel, COUNT(*) AS Findings FROM b GROUP BY 1", "1"),
)
def _(spark, sf):
    return hunting.count_by(S.base(spark, sf, "1d"), "SeverityLevel")


@check(
    "f7_threat_categories",
    O.with_network("SELECT ThreatCategory, COUNT(*) AS Findings FROM network GROUP BY 1", "7"),
)
def _(spark, sf):
    return hunting.count_by(network_of(spark, sf, "7d"), "ThreatCategory")


@check("f8_compliance", COMPLIANCE)
def _(spark, sf):
    return hunting.count_by(sessions_of(spark, sf, compliant_only=False), "ASIMCompliance")


@check(
    "f9_hourly_ingestion",
    O.with_table(
        "SELECT date_trunc('hour', TimeGenerated) AS Hour, COUNT(*) AS RecordCount FROM t "
        f"WHERE TimeGenerated > {AS_OF_SQL} - INTERVAL '24' HOUR GROUP BY 1"
    ),
)
def _(spark, sf):
    return hunting.hourly_ingestion(S.table(spark, sf, "1d"), AS_OF)


@check(
    "f10_latest_hours",
    O.with_table(
        "SELECT date_trunc('hour', TimeGenerated) AS Hour, MAX(TimeGenerated) AS LatestRecord, COUNT(*) AS RecordCount "
        "FROM t GROUP BY 1 ORDER BY 1 DESC LIMIT 48"
    ),
)
def _(spark, sf):
    return hunting.latest_hours(S.table(spark, sf))


@check(
    "f11_severity_distribution",
    O.with_base("SELECT level AS SeverityLevel, sev AS Severity, COUNT(*) AS Findings FROM b GROUP BY 1, 2", "7"),
)
def _(spark, sf):
    return hunting.severity_distribution(S.base(spark, sf, "7d"))


@check(
    "f12_finding_types",
    O.with_base("SELECT ActivityType AS FindingType, COUNT(*) AS Findings FROM b GROUP BY 1", "7"),
)
def _(spark, sf):
    return hunting.finding_types(S.base(spark, sf, "7d"))


SEARCH = " OR ".join(f"contains(lower(ActivityType), '{p}')" for p in ("network", "backdoor", "trojan", "recon"))


@check(
    "f13_search_types",
    O.with_base(f"SELECT Id AS FindingId, ActivityType AS FindingType, EventTime FROM b WHERE {SEARCH}", "7"),
)
def _(spark, sf):
    found = hunting.search_types(S.base(spark, sf, "7d"), "Network", "Backdoor", "Trojan", "Recon")
    return found.select("FindingId", "FindingType", "EventTime")


@check(
    "f13_newest_matches",
    O.with_base(
        f"SELECT Id AS FindingId, ActivityType AS FindingType, TimeGenerated FROM b WHERE {SEARCH} "
        "ORDER BY TimeGenerated DESC, Id LIMIT 10",
        "7",
    ),
)
def _(spark, sf):
    found = hunting.search_types(S.base(spark, sf, "7d"), "Network", "Backdoor", "Trojan", "Recon")
    return hunting.newest(found, 10, "FindingId").select("FindingId", "FindingType", "TimeGenerated")


@check("f14_missing_ids", O.with_base("SELECT TimeGenerated, ActivityType AS FindingType FROM b WHERE Id = ''"))
def _(spark, sf):
    return hunting.missing_ids(S.base(spark, sf)).select("TimeGenerated", "FindingType")


@check("f14_missing_documents", O.with_table("SELECT Id, Arn FROM t WHERE NOT has_service"))
def _(spark, sf):
    """Our mapping fills an absent service with ``{}``; a table filled by others holds null there, as here."""
    service = F.col("ServiceDetails")
    theirs = S.table(spark, sf).withColumn("ServiceDetails", F.when(F.to_json(service) != "{}", service))
    return hunting.missing_documents(theirs, AS_OF, "30d").select("Id", "Arn")


@check(
    "f15_hourly_trend",
    O.with_base(
        "SELECT date_trunc('hour', EventTime) AS Hour, ActivityType AS FindingType, COUNT(*) AS Findings FROM b GROUP BY 1, 2",
        "7",
    ),
)
def _(spark, sf):
    return hunting.hourly_trend(S.base(spark, sf, "7d"))


@check(
    "f16_urgent",
    O.with_base(
        f"{O.BASE_SELECT} WHERE EventTime > {AS_OF_SQL} - INTERVAL '6' HOUR AND level IN ('High', 'Critical')", "1"
    ),
)
def _(spark, sf):
    return hunting.urgent(S.base(spark, sf, "1d"), AS_OF, "6h")


@check(
    "f17_daily_volume",
    O.with_table(
        f"SELECT date_trunc('day', TimeGenerated)::TIMESTAMP AS Day, SUM(strlen({O.ROW_JSON}))::DOUBLE / 1048576.0 AS DataSizeMB "
        f"FROM t WHERE TimeGenerated > {AS_OF_SQL} - INTERVAL '30' DAY GROUP BY 1"
    ),
)
def _(spark, sf):
    return hunting.daily_volume(S.table(spark, sf), AS_OF)


@check(
    "f17_daily_volume_days",
    O.with_table(
        "SELECT date_trunc('day', TimeGenerated)::TIMESTAMP AS Day, true AS HasData FROM t "
        f"WHERE TimeGenerated > {AS_OF_SQL} - INTERVAL '30' DAY GROUP BY 1"
    ),
)
def _(spark, sf):
    volume = hunting.daily_volume(S.table(spark, sf), AS_OF)
    return volume.select("Day", (F.col("DataSizeMB") > 0).alias("HasData"))


@check(
    "f18_parse_latency",
    O.with_base(
        "SELECT time_bucket(INTERVAL '5' MINUTE, TimeGenerated) AS Bin, 0.0e0 AS AvgQueryDuration, "
        "0.0e0 AS MaxQueryDuration FROM b GROUP BY 1",
        "1",
    ),
)
def _(spark, sf):
    return hunting.parse_latency(S.base(spark, sf, "1d"), AS_OF)


@check(
    "f19_trace_findings",
    O.with_base(
        "SELECT 'Main' AS Parser, Id AS FindingId, ActivityType AS FindingType, EventTime FROM b WHERE Id = 'f-300' UNION ALL "
        "SELECT 'Network', FindingId, FindingType, EventTime FROM network WHERE FindingId = 'f-300' UNION ALL "
        "SELECT 'IAM', FindingId, FindingType, EventTime FROM identity WHERE FindingId = 'f-300' UNION ALL "
        "SELECT 'ASIM', NetworkSessionId, ThreatName, EventStartTime FROM sessions WHERE NetworkSessionId = 'f-300' "
        "AND ASIMCompliance = 'Compliant'",
        more=",\n" + O.NETWORK + ",\n" + O.SESSIONS + ",\n" + O.IDENTITY,
    ),
)
def _(spark, sf):
    return hunting.trace_finding(
        "f-300", S.base(spark, sf), network_of(spark, sf), identity_of(spark, sf), sessions_of(spark, sf)
    )


@check(
    "f20_quality_shares",
    O.with_quality(
        "SELECT QualityCategory, COUNT(*) AS Records, ROUND(COUNT(*) * 100.0e0 / SUM(COUNT(*)) OVER (), 2) AS Percentage "
        "FROM quality GROUP BY 1"
    ),
)
def _(spark, sf):
    return hunting.quality_shares(quality.quality_categories(S.table(spark, sf), "30d", AS_OF)).withColumn(
        "Percentage", F.col("Percentage").cast("double")
    )


@check(
    "f21_version_issues",
    O.with_quality(
        "SELECT SchemaVersion, COUNT(*) AS Records FROM quality WHERE contains(lower(QualityCategory), 'schema') GROUP BY 1"
    ),
)
def _(spark, sf):
    return hunting.version_issues(quality.quality_categories(S.table(spark, sf), "30d", AS_OF))


@check("f21_schema_versions", O.with_table("SELECT SchemaVersion, COUNT(*) AS Records FROM t GROUP BY 1"))
def _(spark, sf):
    return hunting.schema_versions(S.table(spark, sf))


@check(
    "f22_action_documents",
    O.with_base(
        f"SELECT Id AS FindingId, ActivityType AS FindingType, CASE WHEN {O.CONDITIONS['net']} THEN '{{' || "
        "concat_ws(',', '\"port\":' || CAST(local_port AS VARCHAR), '\"portName\":\"' || local_port_name || '\"') || '}' "
        "END AS Action FROM b WHERE atype = 'NETWORK_CONNECTION'"
    ),
)
def _(spark, sf):
    path = ".action.networkConnectionAction.localPortDetails"
    return hunting.action_documents(S.base(spark, sf), "NETWORK_CONNECTION", path)


@check(
    "f22_service_documents",
    O.with_base(f"SELECT Id AS FindingId, ActivityType AS FindingType, {O.SERVICE_TEXT} AS Document FROM b WHERE atype = 'AWS_API_CALL'"),
)
def _(spark, sf):
    """The documents that API calls are read from, whole."""
    documents = hunting.action_documents(S.base(spark, sf), "AWS_API_CALL", "")
    return documents.select("FindingId", "FindingType", F.col("Action").alias("Document"))


@check(
    "f22_api_documents",
    O.with_base(
        f"SELECT Id AS FindingId, ActivityType AS FindingType, {O.CONDITIONS['api']} AS HasAction FROM b "
        "WHERE atype = 'AWS_API_CALL'"
    ),
)
def _(spark, sf):
    documents = hunting.action_documents(S.base(spark, sf), "AWS_API_CALL", ".action.awsApiCallAction")
    return documents.select("FindingId", "FindingType", F.col("Action").isNotNull().alias("HasAction"))


@check(
    "f23_session_readiness",
    O.with_network(
        "SELECT COUNT(*) FILTER (PrivateIp <> '') AS SrcIpCount, COUNT(*) FILTER (RemoteIp <> '') AS DstIpCount, "
        "COUNT(*) FILTER (Protocol <> '') AS ProtocolCount, COUNT(*) AS TotalRecords FROM network",
        "1",
    ),
)
def _(spark, sf):
    return hunting.session_readiness(network_of(spark, sf, "1d"))


FIREWALL = (
    "firewall AS (SELECT TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(o_orderkey % 43200 AS INTEGER)) AS TimeGenerated, "
    "'10.9.' || CAST(o_custkey % 250 AS VARCHAR) || '.1' AS SourceIP, '203.0.' || CAST(o_custkey % 200 AS VARCHAR) || '.' "
    "|| CAST(o_orderkey % 250 AS VARCHAR) AS DestinationIP, o_orderstatus AS Activity FROM orders)"
)
MORE_SESSIONS = ",\n" + O.NETWORK + ",\n" + O.SESSIONS + ",\n" + FIREWALL


@check(
    "f24_across_sources",
    O.with_base(
        "SELECT 'GuardDuty' AS Source, SrcIpAddr, DstIpAddr FROM sessions WHERE ASIMCompliance = 'Compliant' AND SrcIpAddr "
        "<> '' UNION ALL SELECT 'Firewall', SourceIP, DestinationIP FROM firewall WHERE TimeGenerated > "
        f"{AS_OF_SQL} - INTERVAL '30' DAY",
        more=MORE_SESSIONS,
    ),
)
def _(spark, sf):
    return hunting.across_sources(sessions_of(spark, sf), S.firewall(spark, sf), AS_OF, "30d")


@check(
    "f25_risky_destinations",
    O.with_base(
        "SELECT TimeGenerated, SourceIP, DestinationIP, Activity FROM firewall WHERE TimeGenerated > "
        f"{AS_OF_SQL} - INTERVAL '30' DAY AND DestinationIP IN (SELECT DstIpAddr FROM sessions WHERE ASIMCompliance = "
        "'Compliant' AND ThreatRiskLevel > 70)",
        more=MORE_SESSIONS,
    ),
)
def _(spark, sf):
    return hunting.risky_destinations(sessions_of(spark, sf), S.firewall(spark, sf), AS_OF, "30d")


@check(
    "f26_table_counts",
    "SELECT 'findings' AS TableName, COUNT(*) AS Records FROM events UNION ALL SELECT 'firewall', COUNT(*) FROM orders "
    "UNION ALL SELECT 'geo', COUNT(*) * 2 + 1 FROM nation",
)
def _(spark, sf):
    return tables.table_counts(
        {"findings": S.table(spark, sf), "firewall": S.firewall(spark, sf), "geo": S.geo_ranges(spark, sf)}
    )


@check(
    "f27_recent_samples",
    O.with_table(
        "SELECT AccountId, ActivityType, Arn, Description, Id, PartitionName AS \"Partition\", Region, SchemaVersion, "
        "SeverityInt AS Severity, TimeCreated, TimeGenerated, Title FROM t WHERE TimeGenerated > "
        f"{AS_OF_SQL} - INTERVAL '24' HOUR ORDER BY TimeGenerated DESC, Id, Arn LIMIT 5"
    ),
)
def _(spark, sf):
    return hunting.recent_samples(S.table(spark, sf, "1d"), 5, AS_OF)


# ---- J, N: lookup join and text semantics

GEO = """geo AS (SELECT 3405774848 + n_nationkey * 512 AS lo, 3405774848 + n_nationkey * 512 + 511 AS hi, n_name AS country,
  'wide' AS state, 'City ' || n_nationkey AS city, CAST(n_nationkey AS DOUBLE) AS lat, CAST(-n_nationkey AS DOUBLE) AS lon
  FROM nation UNION ALL SELECT 3405774848 + 25600 + n_nationkey * 256, 3405774848 + 25600 + n_nationkey * 256 + 99,
  n_name, 'narrow', NULL, NULL, NULL FROM nation UNION ALL
  SELECT 3325231104, 3325231104 + 65535, 'Testland', 'block', 'Testville', 1.5, -2.5
  FROM nation WHERE n_nationkey = 0),
located AS (SELECT *, CASE WHEN RemoteIp <> '' THEN CAST(split_part(RemoteIp, '.', 1) AS BIGINT) * 16777216
  + CAST(split_part(RemoteIp, '.', 2) AS BIGINT) * 65536 + CAST(split_part(RemoteIp, '.', 3) AS BIGINT) * 256
  + CAST(split_part(RemoteIp, '.', 4) AS BIGINT) END AS number FROM network)"""
PLACED = O.with_base(
    "SELECT FindingId, RemoteIp, COALESCE(country, '') AS EnrichedCountry, COALESCE(state, '') AS EnrichedState, "
    "COALESCE(city, '') AS EnrichedCity, lat AS EnrichedLatitude, lon AS EnrichedLongitude FROM located LEFT JOIN geo "
    "ON number BETWEEN lo AND hi QUALIFY ROW_NUMBER() OVER (PARTITION BY FindingId ORDER BY hi - lo, lo) = 1",
    more=",\n" + O.NETWORK + ",\n" + GEO,
)
PLACE = ("FindingId", "RemoteIp", *network.GEO_COLUMNS)


@check("j4_geo_lookup", PLACED)
def _(spark, sf):
    return network_of(spark, sf, geo=S.geo(spark, sf)).select(*PLACE)


@check("j4_geo_by_address", PLACED)
def _(spark, sf):
    """The look-up on its own, after a view that was made without it."""
    bare = network_of(spark, sf).drop(*network.GEO_COLUMNS)
    return S.geo(spark, sf).enrich(bare, "RemoteIp").select(*PLACE)


@check(
    "j4_geo_ipv6",
    "SELECT c_custkey AS FindingId, COALESCE(n_name, '') AS EnrichedCountry, CASE WHEN n_name IS NULL THEN '' WHEN c_custkey * 7919 % 65536 >= 32768 "
    "THEN 'upper' ELSE 'whole' END AS EnrichedState, '' AS EnrichedCity, CAST(n_nationkey AS DOUBLE) AS EnrichedLatitude, "
    "CAST(NULL AS DOUBLE) AS EnrichedLongitude FROM customer LEFT JOIN nation ON c_custkey % 40 = n_nationkey",
)
def _(spark, sf):
    """IPv6 addresses of customers in networks of nations, from ranges that were written before."""
    stored = S._kept(spark, sf, "geo", lambda path: GeoRanges(S.geo_ranges(spark, sf), S.geo_networks(spark, sf)).save(path))
    group, host = (F.lower(F.hex(F.expr(x))) for x in ("c_custkey % 40", "c_custkey * 7919 % 65536"))
    address = F.concat(F.lit("2001:DB8:"), group, F.lit(":"), host, F.lit("::1"))
    callers = S.given(spark, sf, "customer").select(F.col("c_custkey").alias("FindingId"), address.alias("address"))
    return GeoRanges.load(spark, stored).enrich(callers, "address").drop("address")


@check(
    "n2_n6_text_tests",
    O.with_table(
        "SELECT Arn, "
        + O.columns(
            has_tor=O.has("ActivityType", "Tor"),
            has_port=O.has("ActivityType", "Port", "Unauthorized"),
            has_crypto=O.has("ActivityType", "cryptocurrency"),
            has_s3=O.has("ActivityType", "S3/"),
            has_trojan=O.has("ActivityType", "Trojan:EC2/"),
            contains_iam="contains(lower(ActivityType), 'iamuser')",
            starts_policy="starts_with(lower(ActivityType), 'policy:')",
            first_of=O.filled("title", "description", "Region"),
        )
        + " FROM t"
    ),
)
def _(spark, sf):
    kind = F.col("ActivityType")
    return S.table(spark, sf).select(
        "Arn",
        has(kind, "Tor").alias("has_tor"),
        has(kind, "Port", "Unauthorized").alias("has_port"),
        has(kind, "cryptocurrency").alias("has_crypto"),
        has(kind, "S3/").alias("has_s3"),
        has(kind, "Trojan:EC2/").alias("has_trojan"),
        contains(kind, "IAMUser").alias("contains_iam"),
        starts_with(kind, "POLICY:").alias("starts_policy"),
        first_text(F.col("Title"), F.col("Description"), F.col("Region")).alias("first_of"),
    )


# ---- G: streams


def _ingested(spark, sf) -> tuple[str, str]:
    table, quarantine = work_folder(spark, "table"), work_folder(spark, "quarantine")
    lines = exports.stream_findings(spark, S.mixed_export(spark, sf), glob="*.txt.gz", max_files=2, partitions=8)
    ingest.start_ingest(lines, table, quarantine, work_folder(spark, "checkpoint")).awaitTermination()
    return table, quarantine


@check(
    "g1_ingest_stream",
    f"WITH {O.TABLE}, {O.MIXED} SELECT COALESCE(contract_error, 'valid') AS outcome, COUNT(*) AS n, "
    "COUNT(DISTINCT CASE WHEN contract_error IS NULL THEN Arn END) AS findings FROM checked GROUP BY 1",
)
def _(spark, sf):
    table, quarantine = _ingested(spark, sf)
    stored = tables.findings(spark, table).select(F.lit("valid").alias("outcome"), "Arn")
    aside = spark.read.parquet(quarantine).select(
        F.col("contract_error").alias("outcome"), F.lit(None).cast("string").alias("Arn")
    )
    return (
        stored.unionByName(aside)
        .groupBy("outcome")
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("Arn").alias("findings"))
    )


def _committed(spark, sf) -> tuple[str, str]:
    """Table and quarantine of the mixed export, ingested as a stream once per session and scale."""

    def write(path):
        lines = exports.stream_findings(spark, S.mixed_export(spark, sf), glob="*.txt.gz", max_files=1, partitions=8)
        ingest.start_ingest(lines, f"{path}/table", f"{path}/quarantine", work_folder(spark, "checkpoint")).awaitTermination()

    path = S._kept(spark, sf, "committed", write)
    return f"{path}/table", f"{path}/quarantine"


@check(
    "g1_day_archive",
    f"WITH {O.TABLE}, {O.MIXED} SELECT Id, Arn, ActivityType, SeverityInt AS Severity, TimeGenerated, COUNT(*) AS copies "
    "FROM checked WHERE contract_error IS NULL GROUP BY ALL",
)
def _(spark, sf):
    """The ingested table with its first half archived, then all but the last week: read once, wherever a row lies."""
    store = archive.DayArchive(_committed(spark, sf)[0], work_folder(spark, "archive"))
    for days in (15, 7):
        store.compact(spark, (AS_OF - timedelta(days=days)).date())
    store.vacuum(spark)
    return store.read(spark).groupBy("Id", "Arn", "ActivityType", "Severity", "TimeGenerated").agg(F.count(F.lit(1)).alias("copies"))


SKETCHED = (("Findings", "Id"), ("FindingTypes", "ActivityType"), ("Accounts", "AccountId"), ("Regions", "Region"))


@check(
    "gb_daily_sketches",
    O.with_table(
        " UNION ALL ".join(
            f"SELECT '{name}' AS Measure, COUNT(DISTINCT CAST(TimeGenerated AS DATE)) AS Days, COUNT(*) AS Records, "
            f"COUNT(DISTINCT {column}) AS Exact, TRUE AS Close FROM t WHERE TimeGenerated >= {AS_OF_SQL} - INTERVAL '14' DAY"
            for name, column in SKETCHED
        )
    ),
)
def _(spark, sf):
    """Estimates from one stored sketch per day, beside the exact counts: close is within five standard errors."""
    path = work_folder(spark, "sketches")
    sketches.write_sketches(S.table(spark, sf), path)
    estimated = sketches.distinct_counts(sketches.read_sketches(spark, path), "14d", AS_OF)
    exact = S.table(spark, sf, "14d").filter(F.col("TimeGenerated") >= F.lit(AS_OF - timedelta(days=14)))
    counted = exact.agg(*[F.count_distinct(column).alias(f"exact_{name}") for name, column in SKETCHED])
    pairs = [F.struct(F.lit(n).alias("Measure"), F.col(n).alias("Estimate"), F.col(f"exact_{n}").alias("Exact")) for n, _ in SKETCHED]
    both = estimated.unionByName(counted, allowMissingColumns=True)
    one = both.agg(*[F.max(c).alias(c) for c in both.columns])
    rows = one.select("Days", "Records", F.explode(F.array(*pairs)).alias("m")).select("Days", "Records", "m.*")
    bound = F.col("Exact") * 5 * 1.04 / 2 ** (sketches.REGISTERS_LOG2 / 2)
    return rows.select("Measure", "Days", "Records", "Exact", (F.abs(F.col("Estimate") - F.col("Exact")) <= bound).alias("Close"))


WHOLE = (
    'Id, Arn, AccountId, ActivityType, Description, PartitionName AS "Partition", Region, SchemaVersion, SeverityInt AS Severity, '
    f"TimeCreated, TimeGenerated, Title, {O.RESOURCE_TEXT} AS Resource, {O.SERVICE_TEXT} AS Service"
)


def whole(rows: DataFrame) -> DataFrame:
    """All 14 columns, documents as text."""
    return rows.withColumns({"Resource": F.to_json("ResourceDetails"), "Service": F.to_json("ServiceDetails")})


@check("g1_ingested_rows", f"WITH {O.TABLE}, {O.MIXED} SELECT {WHOLE} FROM checked WHERE contract_error IS NULL")
def _(spark, sf):
    return whole(tables.findings(spark, _committed(spark, sf)[0]))


@check("g2_unique_store", O.with_table(f"SELECT {WHOLE} FROM t"))
def _(spark, sf):
    """The export twice, file by file, so that times come in any order: every copy is kept once, however late."""
    store = unique.UniqueStore(work_folder(spark, "unique"))
    lines = exports.stream_findings(spark, S.finding_export(spark, sf), glob="*.txt.gz", max_files=4)
    again = exports.stream_findings(spark, S.finding_export(spark, sf), glob="*.txt.gz", max_files=3)
    copies = tables.to_findings_table(exports.unwrap_events(lines.unionByName(again)))
    unique.start_unique(copies, store, work_folder(spark, "checkpoint")).awaitTermination()
    return whole(store.read(spark))


@check("g2_redelivery_stream", O.with_table("SELECT Id, TimeGenerated FROM t"))
def _(spark, sf):
    """The export read twice as one stream: every copy is delivered twice and kept once."""
    out = work_folder(spark, "unique")
    once = exports.stream_findings(spark, S.finding_export(spark, sf), glob="*.txt.gz")
    twice = once.unionByName(exports.stream_findings(spark, S.finding_export(spark, sf), glob="*.txt.gz"))
    copies = tables.to_findings_table(exports.unwrap_events(twice))
    (
        ingest.drop_redeliveries(copies, "90 days")
        .select("Id", "TimeGenerated")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", work_folder(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(out)


@check("g3_latest_stream", f"WITH {O.TABLE} SELECT {WHOLE} FROM ({O.newest(None)}) AS n")
def _(spark, sf):
    store = latest.LatestStore(work_folder(spark, "latest"), compact_every=2, buckets=16)
    lines = exports.stream_findings(spark, S.finding_export(spark, sf), glob="*.txt.gz", max_files=3)
    copies = tables.to_findings_table(exports.unwrap_events(lines))
    latest.start_latest(copies, store, work_folder(spark, "checkpoint")).awaitTermination()
    return whole(store.read(spark))


URGENT = (
    "SELECT COALESCE(TimeCreated, TimeGenerated) AS EventTime, Id AS FindingId, ActivityType AS FindingType, "
    f"CASE WHEN SeverityInt >= 9 THEN 'Critical' ELSE 'High' END AS SeverityLevel, {O.text('title')} AS Title, "
    "AccountId AS AwsAccountId, Region AS AwsRegion FROM {source} AND SeverityInt BETWEEN 7 AND 10 AND SchemaVersion LIKE '2.%' "
    f"AND {O.QUALITY.replace('sev > 0', 'SeverityInt > 0')} >= 60"
)


@check("g4_urgent_stream", O.with_table(URGENT.replace("{source}", "t WHERE TRUE")))
def _(spark, sf):
    out = work_folder(spark, "urgent")
    (
        monitors.urgent_stream(monitors.stream_table(spark, S.table_path(spark, sf)))
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", work_folder(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(out)


@check("g4_committed_alerts", f"WITH {O.TABLE}, {O.MIXED} " + URGENT.replace("{source}", "checked WHERE contract_error IS NULL"))
def _(spark, sf):
    """Alerts of an ingested table, by way of its commits."""
    alerts = work_folder(spark, "alerts")
    monitors.start_urgent(spark, _committed(spark, sf)[0], alerts, work_folder(spark, "checkpoint")).awaitTermination()
    return spark.read.option("recursiveFileLookup", "true").parquet(alerts)


@check(
    "g5_all_hours",
    f"WITH {O.TABLE}, {O.MIXED} SELECT date_trunc('hour', COALESCE(TimeCreated, TimeGenerated)) AS Hour, ActivityType AS FindingType, "
    "COUNT(*) AS Findings FROM checked WHERE contract_error IS NULL GROUP BY 1, 2",
)
def _(spark, sf):
    """Every row of every hour of an ingested table, in whatever order its files came."""
    counts = work_folder(spark, "counts")
    monitors.start_hourly(spark, _committed(spark, sf)[0], counts, work_folder(spark, "checkpoint")).awaitTermination()
    return monitors.hourly_totals(spark, counts)


@check(
    "g5_hourly_counts_stream",
    O.with_table(
        "SELECT date_trunc('hour', EventTime) AS Hour, ActivityType AS FindingType, COUNT(*) AS Findings FROM (SELECT *, "
        "COALESCE(TimeCreated, TimeGenerated) AS EventTime, MAX(COALESCE(TimeCreated, TimeGenerated)) OVER () AS latest "
        "FROM t) AS x GROUP BY 1, 2 HAVING date_trunc('hour', EventTime) + INTERVAL '1' HOUR <= "
        "MAX(date_trunc('millisecond', latest)) - INTERVAL '2' HOUR"
    ),
)
def _(spark, sf):
    out = work_folder(spark, "hourly")
    (
        monitors.hourly_counts(monitors.stream_table(spark, S.table_path(spark, sf)))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", work_folder(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(out)


@check(
    "g6_silence_monitor",
    _last_hours("2").replace(
        "{select}",
        f"SELECT DISTINCT {AS_OF_SQL} AS CheckTime, {NOTES}, h.*, l.* FROM (SELECT {HEALTH} FROM b) AS h, (SELECT CASE WHEN COUNT(*) = 0 "
        f"THEN 'No data - check KMS permissions' WHEN {AS_OF_SQL} - MAX(TimeGenerated) > INTERVAL '30' MINUTE THEN "
        "'Data lag detected' ELSE 'KMS permissions working' END AS LagStatus, "
        f"(epoch_us({AS_OF_SQL}) - epoch_us(MAX(TimeGenerated))) / 1000000.0e0 AS DataLagSeconds FROM t "
        f"WHERE TimeGenerated > {AS_OF_SQL} - INTERVAL '1' HOUR) AS l",
    ),
)
def _(spark, sf):
    alerts = work_folder(spark, "alerts")
    clock = exports.stream_findings(spark, S.finding_export(spark, sf), glob="*.txt.gz")
    reader = monitors.table_reader(spark, S.table_path(spark, sf), "1d", AS_OF)
    monitors.start_monitor(clock, reader, alerts, work_folder(spark, "checkpoint"), AS_OF).awaitTermination()
    return spark.read.option("recursiveFileLookup", "true").parquet(alerts)
