"""Reference files: descriptor, structural validation, full reload."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from trailperks import schemas
from trailperks.operators.audit import logged_step
from trailperks.session import new_run_folder
from trailperks.sources.layers import Layers


class InvalidFileError(ValueError):
    """The file may not be loaded. ``listed`` names the folder with all repeated ids, if there are any."""

    def __init__(self, reason: str, listed: str | None = None) -> None:
        super().__init__(f"{reason}, all of them in {listed}" if listed else reason)
        self.reason, self.listed = reason, listed


SALARIES = "raw.salaries"
# The names of the employees, in one folder for each range of so many ids.
NAMES = "notifications.noms_salaries"
ID_RANGE = 10_000


@dataclass(frozen=True)
class ReferenceFile:
    """How one reference file becomes a raw table."""

    step: str
    table: str
    columns: dict[str, str]
    schema: T.StructType

    @property
    def key_header(self) -> str:
        return next(header for header, column in self.columns.items() if column == "id_salarie")


# Column headers of the two files.
HR_FILE = ReferenceFile(
    step="ingestion_salaries",
    table=SALARIES,
    columns={
        "ID salarié": "id_salarie",
        "Nom": "nom",
        "Prénom": "prenom",
        "Date de naissance": "date_naissance",
        "BU": "bu",
        "Date d'embauche": "date_embauche",
        "Salaire brut": "salaire_brut",
        "Type de contrat": "type_contrat",
        "Nombre de jours de CP": "jours_cp",
        "Adresse du domicile": "adresse",
        "Moyen de déplacement": "moyen_deplacement",
    },
    schema=schemas.RAW_SALARIES,
)
SPORT_FILE = ReferenceFile(
    step="ingestion_sports",
    table="raw.sports",
    columns={"ID salarié": "id_salarie", "Pratique d'un sport": "pratique_sport"},
    schema=schemas.RAW_SPORTS,
)

def read_file(spark: SparkSession, path: str, kind: str = "csv") -> DataFrame:
    """Read a reference file with its file name; CSV columns stay text until they are cast."""
    reader = spark.read.option("header", True) if kind == "csv" else spark.read
    return reader.format(kind).load(path).withColumn(
        "fichier_source", F.col("_metadata.file_name")
    )


def check_columns(frame: DataFrame, reference: ReferenceFile) -> None:
    lost = [header for header in reference.columns if header not in frame.columns]
    if lost:
        raise InvalidFileError(f"missing columns: {lost}")


def key_counts(frame: DataFrame, reference: ReferenceFile) -> DataFrame:
    """(id, unreadable, n): rows per id as it will be stored, so ``7``, ``07`` and `` 7 `` are one."""
    key = F.col(f"`{reference.key_header}`")
    if dict(frame.dtypes)[reference.key_header] == "string":
        key = F.nullif(F.trim(key), F.lit(""))
    number = key.try_cast(reference.schema["id_salarie"].dataType)
    return (
        frame.select(number.alias("id"), (key.isNotNull() & number.isNull()).alias("unreadable"))
        .groupBy("id", "unreadable")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def duplicated_ids(frame: DataFrame, reference: ReferenceFile) -> DataFrame:
    """(id, n) of the ids that stand in more than one row."""
    return key_counts(frame, reference).where("id is not null and n > 1").select("id", "n")


def validate(frame: DataFrame, reference: ReferenceFile) -> int:
    """Refuse a file with missing columns, no rows, empty, unreadable or repeated ids; return its rows.

    One aggregation per file; all repeated ids are written to a table, only counts reach the driver.
    """
    check_columns(frame, reference)
    n, repeated_id = F.col("n"), F.col("id").isNotNull() & (F.col("n") > 1)
    rows, empty, unreadable, repeated = key_counts(frame, reference).agg(
        F.coalesce(F.sum(n), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("id").isNull() & ~F.col("unreadable"), n)), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("unreadable"), n)), F.lit(0)),
        F.count_if(repeated_id),
    ).first()
    if rows == 0:
        raise InvalidFileError("the file has no rows")
    if empty:
        raise InvalidFileError(f"{empty} rows without id")
    if unreadable:
        raise InvalidFileError(f"{unreadable} rows with an unreadable id")
    if repeated:
        listed = new_run_folder(frame.sparkSession, "repeated-ids")
        duplicated_ids(frame, reference).write.parquet(listed)
        raise InvalidFileError(f"{repeated} repeated ids", listed)
    return rows


def typed(frame: DataFrame, reference: ReferenceFile, loaded_at: datetime) -> DataFrame:
    """Rename and cast to the raw table, in its column order; NaN and blank cells become NULL."""
    kinds = {field.name: field.dataType for field in reference.schema.fields}
    columns = []
    for header, name in reference.columns.items():
        value = F.col(f"`{header}`")
        if dict(frame.dtypes)[header] in ("double", "float"):
            value = F.when(~F.isnan(value), value)
        elif dict(frame.dtypes)[header] == "string" and kinds[name] != T.StringType():
            value = F.nullif(F.trim(value), F.lit(""))
        if isinstance(kinds[name], T.DateType):
            value = F.to_date(value)
        columns.append(value.cast(kinds[name]).alias(name))
    return frame.select(
        *columns, "fichier_source", F.lit(loaded_at).cast("timestamp").alias("charge_le")
    )


def read_validated(
    spark: SparkSession, path: str, reference: ReferenceFile, loaded_at: datetime, kind: str = "csv"
) -> DataFrame:
    frame = read_file(spark, path, kind)
    validate(frame, reference)
    return typed(frame, reference, loaded_at)


def full_reload(
    layers: Layers, path: str, reference: ReferenceFile, loaded_at: datetime, kind: str = "csv"
) -> int:
    """Replace the raw table with the file. A refused file leaves the table and logs the failure."""

    def work() -> int:
        frame = read_file(layers.spark, path, kind)
        rows = validate(frame, reference)
        layers.reload(reference.table, typed(frame, reference, loaded_at))
        if reference.table == SALARIES:
            store_names(layers)
        return rows

    return logged_step(layers, reference.step, work)


def names_directory(salaries: DataFrame) -> DataFrame:
    """Id and trimmed names; the only personal columns the announcements may read."""
    return salaries.select(
        "id_salarie", F.trim("prenom").alias("prenom"), F.trim("nom").alias("nom")
    )


def store_names(layers: Layers) -> None:
    """Store the names of the newest HR table by ranges of ids, for readers that need few of them."""
    names = names_directory(layers.read(SALARIES))
    tranche = F.floor(F.col("id_salarie") / ID_RANGE).cast("int")
    layers.reload(NAMES, names.withColumn("tranche", tranche), partition_by=("tranche",))
