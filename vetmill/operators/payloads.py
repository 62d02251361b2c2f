"""Patient payloads with default ids, and the discovery of those ids in landed JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetmill.functions.json_ids import ID_KEYS, LABEL_KEYS, json_ids

#: The payload's fields.
REQUIRED = ["accountId", "breedId", "name", "speciesId"]
OPTIONAL = ["birthdate", "color", "deceasedDate", "insuranceInfo", "microchipInfo", "pimsCode", "sexId"]


def merge_ids(ids: Column, defaults: list[int]) -> Column:
    """The ids and then the defaults, each once, in the order first seen."""
    own = F.coalesce(ids.cast("array<bigint>"), F.array().cast("array<bigint>"))
    more = F.array(*map(F.lit, defaults)) if defaults else F.array()
    return F.array_distinct(F.concat(own, more.cast("array<bigint>")))


def build_patient_payloads(patients: DataFrame, default_alert_id: int, default_reminder_ids: list[int] = ()) -> tuple[DataFrame, DataFrame]:
    """The patients with payload, a JSON text without its null options; and those that lack a
    required value, with the first one's name as reason."""
    have = patients.columns
    for c in REQUIRED:
        if c not in have:
            raise ValueError(f"the patients have no column {c}")
    ids = lambda c: F.col(c) if c in have else F.lit(None).cast("array<bigint>")
    fields = [*REQUIRED, merge_ids(ids("alertIds"), [default_alert_id]).alias("alertIds"),
              merge_ids(ids("reminderIds"), list(default_reminder_ids)).alias("reminderIds"), *[c for c in OPTIONAL if c in have]]
    lacks = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED])
    good = patients.where(lacks.isNull()).withColumn("payload", F.to_json(F.struct(*fields)))
    return good, patients.where(lacks.isNotNull()).withColumn("reason", lacks)


def sample_patient(spark, account_id: str, name: str, breed_id: int, species_id: str, sex_id: str, pims_code: str | None = None) -> DataFrame:
    """One patient row for a trial payload; without a code the payload leaves it out."""
    row = (account_id, breed_id, name, species_id, sex_id, pims_code or None)
    return spark.createDataFrame([row], "accountId string, breedId int, name string, speciesId string, sexId string, pimsCode string")


def sample_patients(accounts: DataFrame, name: str, breed_id: int, species_id: str, sex_id: str) -> DataFrame:
    """A patient row for a trial payload for each account; where the account has no code the payload leaves it out."""
    return accounts.select(F.col("account_id").alias("accountId"), F.lit(breed_id).alias("breedId"), F.lit(name).alias("name"), F.lit(species_id).alias("speciesId"),
                           F.lit(sex_id).alias("sexId"), F.nullif(F.col("pims_id"), F.lit("")).alias("pimsCode"))


def ordered_ids(feed: DataFrame, ids: Column) -> DataFrame:
    """id, pos: every id of a feed once, with the place (feed_pos, index) where it is first seen."""
    each = feed.select("feed_pos", F.posexplode(ids).alias("idx", "id"))
    return each.groupBy("id").agg(F.min(F.struct("feed_pos", "idx")).alias("pos"))


def alert_ids(alerts: DataFrame) -> DataFrame:
    return ordered_ids(alerts, json_ids(F.col("raw"), ID_KEYS, True, ("alerts", "data", "items", "results")))


def reminder_ids(reminders: DataFrame) -> DataFrame:
    """Label ids; if the whole feed has none, any ids under the feed's lists."""
    labels = ordered_ids(reminders, json_ids(F.col("raw"), LABEL_KEYS, False))
    other = ordered_ids(reminders, json_ids(F.col("raw"), ID_KEYS, True, ("reminders", "data", "items", "results")))
    none = labels.limit(1).agg((F.count("*") == 0).alias("_none"))
    return labels.unionByName(other.crossJoin(F.broadcast(none)).where("_none").drop("_none"))  # one row


def discover_default_ids(alerts: DataFrame, reminders: DataFrame, most: int = 1000) -> tuple[int | None, list[int]]:
    """The first alert id, and the first reminder ids (at most `most`), in feed order."""
    first = alert_ids(alerts).orderBy("pos").first()
    ids = [r.id for r in reminder_ids(reminders).orderBy("pos").limit(most).collect()]
    return (first.id if first else None), ids
