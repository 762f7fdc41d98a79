"""Raw health-record events and a patient dimension derived from the given tables.

The SQL text is shared by Spark and by the SQL oracle; only the dialect pieces in braces differ.
Faults are injected by fixed arithmetic on the row number, no row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DIALECTS = {
    "spark": {
        "ms": "unix_micros(CAST(ts AS TIMESTAMP)) div 1000",
        "iso": "date_format(timestamp_millis({0}), 'yyyy-MM-dd''T''HH:mm:ss.SSS''Z''')",
    },
    "duckdb": {
        "ms": "epoch_us(ts) // 1000",
        "iso": "strftime(make_timestamp(CAST(({0}) * 1000 AS BIGINT)), '%Y-%m-%dT%H:%M:%S.%gZ')",
    },
}

_EVENT_VIEW = """
WITH b AS (
  SELECT event_id AS n, user_id, event_type AS et, @MS@ AS ts_ms,
         CAST(floor(value * 10) AS BIGINT) AS iv
  FROM events
), c AS (
  SELECT n, ts_ms, iv, et, user_id,
    CASE WHEN n % 50 = 7 AND n >= 20 THEN n - 1 - n % 13 ELSE n END AS id_n,
    CASE WHEN et = 'error' AND n % 223 = 5 THEN -20
         WHEN et = 'error' AND iv % 3 = 0 THEN 35 + iv % 146
         WHEN et = 'error' AND iv % 3 = 1 THEN 6 + iv % 37
         WHEN et = 'error' THEN 4 + iv % 25
         WHEN et = 'view' AND n % 211 = 11 THEN 9990
         WHEN et = 'view' THEN 550 + 10 * (iv % 96)
         WHEN et = 'click' THEN 360 + iv % 48
         WHEN et = 'purchase' AND n % 61 = 13 THEN -100
         ELSE 10 + iv END AS tenths
  FROM b
), d AS (
  SELECT n AS arrival_seq, ts_ms, iv, et,
    '00000000-0000-4000-8000-' || lpad(CAST(id_n AS STRING), 12, '0') AS event_id,
    CASE WHEN n % 97 = 5 THEN NULL
         ELSE 'P' || lpad(CAST(user_id + CASE WHEN n % 11 = 6 THEN 5000000 ELSE 0 END AS STRING), 7, '0')
    END AS patient_id,
    CASE WHEN n % 101 = 3 THEN 'fax' WHEN et IN ('view','click') THEN 'vital'
         WHEN et = 'error' THEN 'lab' WHEN et = 'purchase' THEN 'medication'
         ELSE 'admission' END AS event_type,
    CASE WHEN n % 103 = 8 THEN NULL
         ELSE ts_ms - CASE WHEN n % 41 = 9 THEN 7200000 WHEN n % 43 = 10 THEN 2700000
                           WHEN n % 9 = 4 THEN 600000 ELSE 0 END
    END AS event_time_ms,
    n % 107 = 2 AS has_phi,
    CASE WHEN tenths < 0 THEN '-' ELSE '' END
      || CAST(CAST(floor(abs(tenths) / 10.0) AS BIGINT) AS STRING)
      || '.' || CAST(abs(tenths) % 10 AS STRING) AS num
  FROM c
)
SELECT arrival_seq, event_id, patient_id, event_type, event_time_ms, ts_ms AS emit_ms,
  ts_ms + 1 + iv % 5000 AS processed_ms, has_phi,
  CASE event_type WHEN 'vital' THEN 'bedside-monitor' WHEN 'lab' THEN 'lab-system'
                  WHEN 'medication' THEN 'ehr-hl7' ELSE 'patient-portal' END AS source,
  CASE et WHEN 'view' THEN '{"name":"heart_rate","value":' || num || ',"unit":"bpm"}'
          WHEN 'click' THEN '{"name":"temperature_c","value":' || num || ',"unit":"C"}'
          WHEN 'error' THEN '{"test":"' || CASE iv % 3 WHEN 0 THEN 'wbc' WHEN 1 THEN 'lactate'
                                                       ELSE 'creatinine' END
                            || '","result":' || num || ',"unit":"u"}'
          WHEN 'purchase' THEN CASE WHEN arrival_seq % 61 = 14 THEN '{"dose":-10}'
              ELSE '{"medication":"vancomycin","dose":' || num || ',"unit":"mg","route":"IV"}' END
          ELSE CASE WHEN arrival_seq % 67 = 1 THEN '{"dose":-10}'
              ELSE '{"department":"ICU","acuity":' || CAST(1 + iv % 5 AS STRING) || '}' END
  END AS payload
FROM d
"""

_RAW_TEXT = """
SELECT arrival_seq, processed_ms,
  '{"event_id":"' || event_id || '"'
  || CASE WHEN patient_id IS NULL THEN '' ELSE ',"patient_id":"' || patient_id || '"' END
  || ',"event_type":"' || event_type || '","event_time":"'
  || CASE WHEN event_time_ms IS NULL THEN 'not-a-timestamp' ELSE @ISO_EVENT@ END
  || '","source_emit_time":"' || @ISO_EMIT@
  || '","source":"' || source || '","schema_version":"ehr.v1","payload":' || payload
  || CASE WHEN has_phi THEN ',"patient_name":"Jane Example"' ELSE '' END
  || '}' AS raw
FROM event_view
"""

_PATIENTS = """
SELECT 'P' || lpad(CAST(c_custkey AS STRING), 7, '0') AS patient_id,
  CASE c_custkey % 5 WHEN 0 THEN '0-17' WHEN 1 THEN '18-34' WHEN 2 THEN '35-49'
                     WHEN 3 THEN '50-64' ELSE '65+' END AS age_band,
  c_mktsegment AS home_department,
  CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS STRING) AS risk_score
FROM customer
"""


def event_view_sql(dialect: str) -> str:
    return _EVENT_VIEW.replace("@MS@", DIALECTS[dialect]["ms"])


def raw_text_sql(dialect: str) -> str:
    iso = DIALECTS[dialect]["iso"]
    return _RAW_TEXT.replace("@ISO_EVENT@", iso.format("event_time_ms")).replace(
        "@ISO_EMIT@", iso.format("emit_ms")
    )


def patients_sql() -> str:
    """Every customer is a patient; some events are of patients that no customer is."""
    return _PATIENTS


def _sql_over(text: str, view: str, source: DataFrame) -> DataFrame:
    source.createOrReplaceTempView(view)
    return source.sparkSession.sql(text)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed events, one row per row of the `events` table."""
    return _sql_over(event_view_sql("spark"), "events", _table(spark, sf_dir, "events"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as raw JSON text with arrival order and ingest time."""
    return _sql_over(raw_text_sql("spark"), "event_view", event_view(spark, sf_dir))


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patient attributes, one row per patient."""
    return _sql_over(patients_sql(), "customer", _table(spark, sf_dir, "customer"))
