"""Staging models: cleaning and derived columns, no row is dropped."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from trailperks import labels as L
from trailperks.functions import rules
from trailperks.functions.numbers import round_ratio

SPACE_TRIMMED = ("nom", "prenom", "bu", "type_contrat", "moyen_deplacement")


def staged_activities(activities: DataFrame, speed_limits: DataFrame) -> DataFrame:
    """Measures and validity of each activity; implausible ones are kept and flagged."""
    metres, micros = F.col("distance_m"), rules.elapsed_us(F.col("date_debut"), F.col("date_fin"))
    valid = rules.is_valid(
        F.col("date_debut"), F.col("date_fin"), metres, F.col("vitesse_max_kmh")
    )
    return activities.join(speed_limits, "type_activite", "left").select(
        "id_activite",
        "id_salarie",
        "date_debut",
        "date_fin",
        rules.paris_date(F.col("date_debut")).alias("date_activite"),
        "type_activite",
        "distance_m",
        rules.distance_km(metres).alias("distance_km"),
        rules.duration_min(micros).alias("duree_min"),
        rules.speed_kmh(metres, micros).alias("vitesse_kmh"),
        "commentaire",
        "source",
        valid.alias("est_valide"),
    )


def staged_salaries(salaries: DataFrame, as_of: date) -> DataFrame:
    """Trimmed HR rows with age, age band and commute flags."""
    trimmed = salaries.withColumns({name: F.trim(name) for name in SPACE_TRIMMED})
    age = rules.completed_years(F.col("date_naissance"), as_of)
    mode = F.col("moyen_deplacement")
    return trimmed.select(
        "id_salarie",
        "nom",
        "prenom",
        "date_naissance",
        age.alias("age"),
        rules.age_band(age).alias("tranche_age"),
        "bu",
        "date_embauche",
        "salaire_brut",
        "type_contrat",
        "jours_cp",
        "adresse",
        "moyen_deplacement",
        rules.is_active_commute(mode).alias("trajet_sportif"),
        rules.route_mode(mode).alias("mode_api"),
    )


def staged_sports(sports: DataFrame) -> DataFrame:
    """Declared sport with known misspellings put right; blank means none."""
    label = F.nullif(F.trim("pratique_sport"), F.lit(""))
    fixed = label
    for wrong, right in L.SPORT_FIXES.items():
        fixed = F.when(label == wrong, right).otherwise(fixed)
    return sports.select(
        "id_salarie", fixed.alias("sport_declare"), label.isNotNull().alias("pratique_declaree")
    )


def staged_distances(distances: DataFrame) -> DataFrame:
    """Commute distances in kilometres (one decimal) and whole minutes."""
    return distances.select(
        "id_salarie",
        F.col("adresse").alias("adresse_calculee"),
        "mode_api",
        round_ratio(F.col("distance_m"), 1000, 1).alias("distance_km"),
        round_ratio(F.col("duree_s"), 60, 0).alias("duree_min"),
        F.col("statut").alias("statut_api"),
        "calcule_le",
    )
