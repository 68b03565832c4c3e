"""Population profile: the HR file joined with declared sports, and its summaries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from trailperks import labels as L
from trailperks.functions import geo, rules, text
from trailperks.operators.joins import count_by, null_safe_left_join
from trailperks.operators.quantiles import quantiles
from trailperks.params import Params

DAYS_PER_YEAR = 365.25


def employee_sports(salaries: DataFrame, sports: DataFrame) -> DataFrame:
    """Hire date and declared sport per employee; only the needed columns are read."""
    people = salaries.select("id_salarie", "date_embauche")
    declared = sports.select("id_salarie", "pratique_sport")
    return people.join(declared, "id_salarie", "left").select(
        "id_salarie", "date_embauche", text.strip_blanks(F.col("pratique_sport")).alias("sport")
    )


def population(salaries: DataFrame, sports: DataFrame, as_of: date) -> DataFrame:
    """HR rows with declared sport, ages in decimal years, address parts and commute flag."""
    today = F.lit(as_of)
    sport = text.strip_blanks(F.col("pratique_sport"))
    for wrong, right in L.SPORT_FIXES.items():
        sport = F.when(sport == wrong, right).otherwise(sport)
    declared = sports.select("id_salarie", F.nullif(sport, F.lit("")).alias("sport"))
    postcode = text.address_postcode(F.col("adresse"))
    age = (F.date_diff(today, "date_naissance") / DAYS_PER_YEAR).cast("int")
    return salaries.join(declared, "id_salarie", "left").select(
        "id_salarie", "date_naissance", "bu", "date_embauche", "salaire_brut", "type_contrat",
        "jours_cp", "adresse", "moyen_deplacement", "sport",
        F.col("sport").isNotNull().alias("pratique_sport"),
        age.alias("age"),
        (F.date_diff(today, "date_embauche") / DAYS_PER_YEAR).alias("anciennete"),
        (F.date_diff("date_embauche", "date_naissance") / DAYS_PER_YEAR).alias("age_embauche"),
        closed_age_band(age).alias("tranche_age"),
        postcode.alias("code_postal"),
        text.address_town(F.col("adresse")).alias("commune"),
        text.department(postcode).alias("departement"),
        rules.is_active_commute(F.col("moyen_deplacement")).alias("trajet_sportif"),
    )


def closed_age_band(age: Column) -> Column:
    """Age bands closed on the right, from above 0 to 99; NULL outside."""
    band = rules.age_band(age)
    return F.when((age > 0) & (age <= 99), band)


def null_profile(table: DataFrame) -> DataFrame:
    """Missing values of every column, from one pass: ``colonne, manquants``."""
    measured = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in table.columns])
    return measured.unpivot([], table.columns, "colonne", "manquants")


def id_differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Ids that are in one table only, counted per direction."""

    def only_in(a: DataFrame, b: DataFrame, label: str) -> DataFrame:
        alone = a.select(key).distinct().join(b.select(key), key, "left_anti")
        return alone.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("sens"), "n")

    return only_in(left, right, "gauche").unionByName(only_in(right, left, "droite"))


def sanity_counts(people: DataFrame, as_of: date) -> DataFrame:
    """Rows that break each sanity rule: ``controle, lignes``."""
    conditions = (
        F.col("date_embauche") > F.lit(as_of),
        F.col("age_embauche") < 16,
        ~F.col("age").between(16, 70),
        F.col("salaire_brut") <= 0,
        ~F.col("jours_cp").between(0, 40),
    )
    names = [f"c{i}" for i in range(len(conditions))]
    measured = people.agg(*[F.count_if(c).alias(n) for c, n in zip(conditions, names)])
    entries = [
        F.struct(F.lit(label).alias("controle"), F.col(name).alias("lignes"))
        for label, name in zip(L.SANITY_CHECKS, names)
    ]
    return measured.select(F.explode(F.array(*entries)).alias("c")).select("c.*")


def describe(rows: DataFrame, columns: list[str], *keys: str) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles per column, optionally per group.

    Quartiles are exact with linear interpolation; no task holds all distinct values.
    """
    measures, entries = [], []
    for number, column in enumerate(columns):
        value = F.col(column).cast("double")
        measured = {
            "count": F.count(value),
            "mean": F.round(F.avg(value), 1),
            "std": F.round(F.stddev_samp(value), 1),
            "min": F.round(F.min(value), 1),
            "max": F.round(F.max(value), 1),
        }
        measures += [measure.alias(f"{name}{number}") for name, measure in measured.items()]
        shown = [F.col(f"{name}{number}").alias(name) for name in measured]
        entries.append(F.struct(F.lit(column).alias("colonne"), *shown))
    described = rows.groupBy(*keys).agg(*measures)
    described = described.select(*keys, F.explode(F.array(*entries)).alias("c")).select(*keys, "c.*")
    found = quantiles(rows, {column: F.col(column) for column in columns}, keys=keys)
    joined = null_safe_left_join(described, found, [*keys, "colonne"])
    quartiles = [F.round(f"q{n}", 1).alias(name) for n, name in enumerate(("p25", "p50", "p75"))]
    return joined.select(*keys, "colonne", "count", "mean", "std", "min", "max", *quartiles)


def value_shares(rows: DataFrame, column: str) -> DataFrame:
    """Rows per value and their share of all rows with a value."""
    counted = count_by(rows.where(F.col(column).isNotNull()), column)
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("part", F.col("n") / total)


def practice_rate(people: DataFrame, key: str) -> DataFrame:
    """Employees who declare a sport: number, headcount and rate per group."""
    flag = F.col("pratique_sport").cast("int")
    return people.groupBy(key).agg(
        F.sum(flag).alias("sportifs"), F.count("pratique_sport").alias("effectif"),
        F.avg(flag).alias("taux"),
    )


def crosstab(people: DataFrame) -> DataFrame:
    """Travel mode by declared sport, with totals; combinations that do not occur count 0."""
    total = L.CROSSTAB_TOTAL
    labelled = people.where(F.col("moyen_deplacement").isNotNull()).select(
        F.col("moyen_deplacement").alias("mode"),
        F.when(F.col("pratique_sport"), L.CROSSTAB_DECLARED).otherwise(L.CROSSTAB_NONE)
        .alias("sport"),
    )
    cells = labelled.cube("mode", "sport").agg(
        F.count(F.lit(1)).alias("n"),
        F.grouping("mode").alias("tous_modes"),
        F.grouping("sport").alias("tous_sports"),
    )
    named = cells.select(
        F.when(F.col("tous_modes") == 1, total).otherwise(F.col("mode")).alias("moyen_deplacement"),
        F.when(F.col("tous_sports") == 1, total).otherwise(F.col("sport")).alias("sport"),
        "n",
    )
    columns = [L.CROSSTAB_NONE, L.CROSSTAB_DECLARED, total]
    return named.groupBy("moyen_deplacement").pivot("sport", columns).sum("n").na.fill(0)


def distinct_and_singletons(rows: DataFrame, column: str) -> DataFrame:
    """Number of distinct values, and of values held by a single row."""
    counted = count_by(rows.where(F.col(column).isNotNull()), column)
    return counted.agg(
        F.count(F.lit(1)).alias("distincts"), F.count_if(F.col("n") == 1).alias("uniques")
    )


def top_values(rows: DataFrame, column: str, limit: int) -> DataFrame:
    """Most frequent values; equal counts in order of the value."""
    counted = count_by(rows.where(F.col(column).isNotNull()), column)
    return counted.orderBy(F.desc("n"), column).limit(limit)


def histogram(rows: DataFrame, value: Column, low: int, high: int, width: int) -> DataFrame:
    """Rows per bin of equal width; the last bin includes its upper edge, values outside are out."""
    inside = rows.select(value.alias("v")).where((F.col("v") >= low) & (F.col("v") <= high))
    floor = (F.floor((F.col("v") - low) / width) * width + low).cast("int")
    return count_by(inside.select(F.least(floor, F.lit(high - width)).alias("borne")), "borne")


def unit_histogram(rows: DataFrame, value: Column) -> DataFrame:
    """Rows per whole number; the edges come from the data, so no value is left out."""
    return count_by(rows.select(F.floor(value).cast("int").alias("borne")), "borne")


def distinct_places(people: DataFrame) -> DataFrame:
    """Town and department pairs, towns known."""
    return people.select("commune", "departement").dropna(subset=["commune"]).distinct()


def estimated_commutes(people: DataFrame, towns: DataFrame, company_town: str) -> DataFrame:
    """Estimated distance between the home town and the company, against the commute limit.

    An unknown department matches the town entry without department.
    """
    centres = towns.select("commune", "departement", "lat", "lon", "codes_postaux")
    company = towns.where(F.col("commune") == company_town)
    lat = company.agg(F.min_by("lat", "code_insee")).scalar()
    lon = company.agg(F.min_by("lon", "code_insee")).scalar()
    placed = null_safe_left_join(people, centres, ["commune", "departement"])
    limit = F.lit(None).cast("int")
    for mode, kilometres in L.COMMUTE_LIMIT_KM.items():
        limit = F.when(F.col("moyen_deplacement") == mode, kilometres).otherwise(limit)
    straight = geo.haversine_km(F.col("lat"), F.col("lon"), lat, lon)
    estimated = placed.withColumns({
        "distance_vol_oiseau_km": straight, "seuil_km": limit,
    }).withColumn("distance_estimee_km", F.col("distance_vol_oiseau_km") * L.DETOUR_FACTOR)
    # An unknown distance or limit is never suspicious.
    over = F.coalesce(F.col("distance_estimee_km") > F.col("seuil_km"), F.lit(False))
    return estimated.withColumn("declaration_suspecte", over)


def suspects_ranked(estimated: DataFrame) -> DataFrame:
    """Suspicious declarations, largest overshoot first."""
    over = F.col("distance_estimee_km") - F.col("seuil_km")
    return (
        estimated.where("declaration_suspecte")
        .withColumn("depassement_km", over)
        .orderBy(F.desc("depassement_km"), "id_salarie")
        .select(
            "id_salarie", "moyen_deplacement", "commune",
            F.round("distance_estimee_km", 1).alias("distance_estimee_km"), "seuil_km",
            F.round("depassement_km", 1).alias("depassement_km"),
        )
    )


def postcode_consistency(placed: DataFrame) -> DataFrame:
    """Whether each postcode belongs to its town; NULL for towns that are not in the cache."""
    return placed.select(
        "id_salarie", "code_postal", "commune", "codes_postaux",
        text.postcode_listed(F.col("code_postal"), F.col("codes_postaux")).alias("cp_coherent"),
    )


def cost_scenarios(estimated: DataFrame, params: Params) -> DataFrame:
    """Beneficiaries and yearly cost of three coarse scenarios, in whole euros, from one pass."""
    commute, sport = F.col("trajet_sportif"), F.col("pratique_sport")
    trusted = commute & ~F.col("declaration_suspecte")
    measured = estimated.agg(
        *[F.count_if(c).alias(f"n{i}") for i, c in enumerate((commute, trusted, sport))],
        *[F.sum(F.when(c, F.col("salaire_brut")).otherwise(0)).alias(f"s{i}")
          for i, c in enumerate((commute, trusted, sport))],
    )
    rate = F.lit(params.taux_prime).cast("decimal(21,12)")
    day = F.lit(params.jours_travailles_an).cast("decimal(15,6)")
    days = F.lit(params.nb_jours_bien_etre).cast("decimal(15,6)")
    costs = (
        F.col("s0").cast("decimal(17,0)") * rate,
        F.col("s1").cast("decimal(17,0)") * rate,
        F.col("s2").cast("decimal(17,0)") * days / day,
    )
    entries = [
        F.struct(
            F.lit(label).alias("scenario"),
            F.col(f"n{i}").alias("beneficiaires"),
            F.bround(cost, 0).cast("long").alias("cout_annuel"),
        )
        for i, (label, cost) in enumerate(zip(L.COST_SCENARIOS, costs))
    ]
    return measured.select(F.explode(F.array(*entries)).alias("c")).select("c.*")


def population_summary(people: DataFrame) -> DataFrame:
    """Headcount, sport and commute shares, payroll, units, sports, median age."""
    return people.agg(
        F.count(F.lit(1)).alias("nb_salaries"),
        F.count_if("pratique_sport").alias("nb_sportifs"),
        F.avg(F.col("pratique_sport").cast("int")).alias("part_sportifs"),
        F.count_if("trajet_sportif").alias("nb_trajets"),
        F.avg(F.col("trajet_sportif").cast("int")).alias("part_trajets"),
        F.sum("salaire_brut").alias("masse_salariale"),
        F.count_distinct("bu").alias("nb_bu"),
        F.count_distinct("sport").alias("nb_sports"),
    ).withColumns({
        "age_median": quantiles(people, {"age": F.col("age")}, (0.5,)).select("q0").scalar(),
        "masse_affichee": text.euros(F.col("masse_salariale")),
    })


def address_quality(people: DataFrame) -> DataFrame:
    """Addresses without postcode, and without comma."""
    return people.agg(
        F.count_if(F.col("code_postal").isNull()).alias("sans_code_postal"),
        F.count_if(~F.contains(F.col("adresse"), F.lit(","))).alias("sans_virgule"),
    )


def matched_towns(names: DataFrame, towns: DataFrame) -> DataFrame:
    """Official town per name: accents, case, hyphens and apostrophes do not matter."""
    official = towns.groupBy(text.folded_name(F.col("nom_officiel")).alias("cle")).agg(
        F.min_by("nom_officiel", "code_insee").alias("nom_officiel"),
        F.min("code_insee").alias("code_insee"),
    )
    keyed = names.withColumn("cle", text.folded_name(F.col("commune")))
    return keyed.join(official, "cle", "left").drop("cle")
