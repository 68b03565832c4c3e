"""Fixed values of the data model.

Labels, limits, patterns and sentence forms that appear in the data or in the results as they are.
"""

# Travel modes of the HR file, and the two that count as an active commute.
MODE_WALK = "Marche/running"
MODE_BIKE = "Vélo/Trottinette/Autres"
TRAVEL_MODES = (MODE_WALK, MODE_BIKE, "Transports en commun", "véhicule thermique/électrique")
ROUTE_MODES = {MODE_WALK: "WALK", MODE_BIKE: "BICYCLE"}

# Answers of the distance service.
ROUTE_FOUND = "ROUTE_EXISTS"
ROUTE_NOT_FOUND = "ROUTE_NOT_FOUND"
ROUTE_UNKNOWN = "INCONNU"
ROUTE_NO_ANSWER = "SANS_REPONSE"
ROUTE_ERROR_PREFIX = "ERREUR_"
ADDRESS_SUFFIX = ", France"
ROUTE_LOT_SIZE = 25
# Raw-metre limits of the preview printed after a distance run.
PREVIEW_LIMIT_M = {"WALK": 15000, "BICYCLE": 25000}

CONTRACT_TYPES = ("CDI", "CDD")

# Exclusive upper age of each band, then the last band.
AGE_BANDS = ((30, "< 30 ans"), (40, "30-39 ans"), (50, "40-49 ans"), (60, "50-59 ans"))
AGE_BAND_LAST = "60 ans et +"

# Declaration statuses.
NOT_CONCERNED = "non concerné"
NOT_VERIFIED = "non vérifiée"
COMPLIANT = "conforme"
SUSPECT = "suspecte"
DECLARATION_STATUSES = (NOT_CONCERNED, NOT_VERIFIED, COMPLIANT, SUSPECT)

# Misspelt sport label of the source file, and its right form.
SPORT_FIXES = {"Runing": "Course à pied"}

ACTIVITY_TYPES = (
    "Badminton", "Basketball", "Boxe", "Course à pied", "Escalade", "Football", "Judo", "Marche",
    "Natation", "Randonnée", "Rugby", "Tennis", "Tennis de table", "Voile", "Vélo", "Équitation",
)

# Highest plausible average speed in km/h; other sports have no limit.
SPEED_LIMITS_KMH = {
    "Course à pied": "25",
    "Marche": "10",
    "Randonnée": "10",
    "Natation": "8",
    "Vélo": "60",
    "Voile": "60",
    "Équitation": "50",
}
MAX_DISTANCE_M = 300000
MAX_DURATION_S = 24 * 3600

# Default rule parameters.
DEFAULT_PARAMS = {
    "taux_prime": "0.05",
    "seuil_marche_km": "15",
    "seuil_velo_km": "25",
    "nb_jours_bien_etre": "5",
    "nb_activites_min": "15",
    "jours_travailles_an": "218",
    "periode_jours": "365",
}

# Recorded activities that match a declared sport, as labelled in the source file.
DECLARED_SPORT_ACTIVITIES = {
    "Runing": ("Course à pied", "Randonnée"),
    "Randonnée": ("Randonnée", "Marche"),
    "Natation": ("Natation",),
    "Triathlon": ("Course à pied", "Vélo", "Natation"),
    "Voile": ("Voile",),
    "Équitation": ("Équitation",),
    "Tennis": ("Tennis",),
    "Badminton": ("Badminton",),
    "Tennis de table": ("Tennis de table",),
    "Football": ("Football",),
    "Rugby": ("Rugby",),
    "Basketball": ("Basketball",),
    "Judo": ("Judo",),
    "Boxe": ("Boxe",),
    "Escalade": ("Escalade",),
}
OCCASIONAL_ACTIVITIES = ("Marche", "Vélo")

# Announcements: which events are announced, and the sentences.
ANNOUNCED_SOURCES = ("live", "strava")
ANNOUNCED_OPERATIONS = ("c",)
UNKNOWN_EMPLOYEE = "Un collègue"
ELISION_LETTERS = "aeéèêiouyh"
SENTENCES_WITH_DISTANCE = {
    "Course à pied": "Bravo {nom} ! Tu viens de courir {distance} en {duree} ! Quelle énergie !",
    "Randonnée": "Magnifique {nom} ! Une randonnée de {distance} terminée en {duree} !",
    "Vélo": "Belle sortie {nom} ! {distance} à vélo en {duree}",
    "Natation": "Splash ! {nom} vient de nager {distance} en {duree}",
    "Marche": "Bien joué {nom} ! {distance} de marche en {duree}",
    "Voile": "Bon vent {nom} ! {distance} de navigation en {duree}",
    "Équitation": "Au galop {nom} ! {distance} à cheval en {duree}",
}
SENTENCE_OTHER_SPORT = "Bravo {nom} ! {distance} {de_sport} en {duree} !"
SENTENCE_WITHOUT_DISTANCE = "Bravo {nom} ! {duree} {de_sport}, quelle séance !"
SPEED_SUFFIX = " — {vitesse} de moyenne"

WEEKDAYS = ("Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche")

# Exploration: postcode then town at the end of an address, departments, company position.
ADDRESS_PATTERN = r"(\d{5})\s+([^,\d][^,]*)$"
DEPARTMENT_NAMES = {"34": "Hérault (34)", "30": "Gard (30)"}
DEPARTMENT_OTHER = "Autre"
EARTH_RADIUS_KM = 6371.0
DETOUR_FACTOR = 1.3
COMMUTE_LIMIT_KM = {MODE_WALK: 15, MODE_BIKE: 25}
SANITY_CHECKS = (
    "Embauche dans le futur", "Embauché avant 16 ans", "Âge hors 16-70 ans", "Salaire <= 0",
    "Jours de CP hors 0-40",
)
CROSSTAB_DECLARED = "Sport déclaré"
CROSSTAB_NONE = "Aucun sport"
CROSSTAB_TOTAL = "Total"
COST_SCENARIOS = (
    "Prime : toutes les déclarations", "Prime : hors déclarations suspectes",
    "Journées bien-être (borne haute)",
)

# Run log.
RUN_OK = "succes"
RUN_FAILED = "echec"
RUN_PENDING = "en_cours"
LOADER_STEP = "chargement_activites"
CHECK_PASS, CHECK_WARN, CHECK_FAIL, CHECK_ERROR = "pass", "warn", "fail", "erreur"

# Why a lot of trips has no distances.
LOT_ABSENT = "absente"
LOT_UNREADABLE = "illisible"

# Texts of the check runs.
CHECK_ERROR_TEXT = "Erreur technique : {problem}"
CHECK_COUNTS_TEXT = "{passed} OK, {warned} avertissement(s), {failed} échec(s)"
CHECK_ERRORS_TEXT = ", {broken} erreur(s) technique(s)"
