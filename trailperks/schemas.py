"""Schemas of the stored tables and of the change event."""

from pyspark.sql import types as T

INT, LONG, TEXT = T.IntegerType(), T.LongType(), T.StringType()
DATE, INSTANT, DOUBLE = T.DateType(), T.TimestampType(), T.DoubleType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


RAW_ACTIVITIES = _schema(
    id_activite=LONG, id_salarie=INT, date_debut=INSTANT, type_activite=TEXT, distance_m=INT,
    date_fin=INSTANT, commentaire=TEXT, source=TEXT, cree_le=INSTANT, operation=TEXT,
    capture_le=INSTANT, charge_le=INSTANT,
)
RAW_SALARIES = _schema(
    id_salarie=INT, nom=TEXT, prenom=TEXT, date_naissance=DATE, bu=TEXT, date_embauche=DATE,
    salaire_brut=INT, type_contrat=TEXT, jours_cp=INT, adresse=TEXT, moyen_deplacement=TEXT,
    fichier_source=TEXT, charge_le=INSTANT,
)
RAW_SPORTS = _schema(id_salarie=INT, pratique_sport=TEXT, fichier_source=TEXT, charge_le=INSTANT)
DISTANCES = _schema(
    id_salarie=INT, adresse=TEXT, mode_api=TEXT, distance_m=INT, duree_s=INT, statut=TEXT,
    calcule_le=INSTANT,
)
SPEED_LIMITS = _schema(type_activite=TEXT, vitesse_max_kmh=T.DecimalType(9, 3))
TOWNS = _schema(
    commune=TEXT, departement=TEXT, nom_officiel=TEXT, code_insee=TEXT, lat=DOUBLE, lon=DOUBLE,
    codes_postaux=TEXT,
)
PIPELINE_RUNS = _schema(
    id_run=TEXT, etape=TEXT, debut=INSTANT, fin=INSTANT, statut=TEXT, nb_lignes=LONG, message=TEXT,
)
QUALITY_CHECKS = _schema(
    execution_id=TEXT, verifie_le=INSTANT, data_source=TEXT, fichier_controle=TEXT,
    table_verifiee=TEXT, controle=TEXT, resultat=TEXT, valeur=DOUBLE,
)

# One message of the change stream: the flattened row image, times as ISO-8601 text.
CHANGE_EVENT = _schema(
    id_activite=LONG, id_salarie=INT, date_debut=TEXT, date_fin=TEXT, type_activite=TEXT,
    distance_m=INT, commentaire=TEXT, source=TEXT, cree_le=TEXT, __op=TEXT, __source_ts_ms=LONG,
)
# A message with its position in the stream, as the file-based stream source carries it.
CHANGE_MESSAGE = _schema(partition=INT, offset=LONG, value=TEXT)

ROUTE_ELEMENTS = T.ArrayType(
    T.StructType([
        T.StructField("originIndex", INT),
        T.StructField("destinationIndex", INT),
        T.StructField("distanceMeters", INT),
        T.StructField("duration", TEXT),
        T.StructField("condition", TEXT),
        T.StructField("status", T.StructType([T.StructField("code", INT)])),
    ])
)
# The answer of the distance service to one lot, its elements as JSON text.
ROUTE_ANSWER = _schema(mode_api=TEXT, lot=LONG, reponse=TEXT)
