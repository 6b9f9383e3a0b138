"""Small fixed dimensions (cities, aliases, languages, labels, keyword lists).

They are data, not code: each list is a few dozen literals inside expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's values for equal results.
# ---------------------------------------------------------------------------
CITIES = [
    "abuja", "accra", "bangalore", "bangkok", "bogota", "buenos aires", "cape town",
    "chennai", "chiang mai", "chicago", "delhi", "guatemala", "houston", "johannesburg",
    "kanpur", "kigali", "kinshasa", "kolkata", "london", "los angeles", "madrid",
    "mexico city", "melbourne", "mumbai", "nairobi", "new york", "paris", "phuket",
    "san salvador", "sydney", "tegucigalpa", "toronto",
]

PILOT_CITIES = ["chiang mai", "guatemala", "kanpur", "kigali", "kolkata"]

# alias -> main city
ALIASES = {
    "new york city": "new york",
    "nyc": "new york",
    "cdmx": "mexico city",
    "ciudad de mexico": "mexico city",
    "ciudad de méxico": "mexico city",
    "distrito federal": "mexico city",
    "mexico df": "mexico city",
    "bogotá": "bogota",
    "bengaluru": "bangalore",
    "ciudad de guatemala": "guatemala",
    "cd. de guatemala": "guatemala",
    "guatemala, ciudad": "guatemala",
    "guatemala ciudad": "guatemala",
    "guatemala city": "guatemala",
    "guatemala, guatemala": "guatemala",
    "new delhi": "delhi",
    "calcutta": "kolkata",
    "kolkatta": "kolkata",
    "calcuta": "kolkata",
    "bombay": "mumbai",
}

# Cities whose bare name does not count as a match (country/city ambiguity).
EXCLUDE_BARE = ["guatemala"]

CITY_LANGS = {
    "abuja": "en", "accra": "en", "bangalore": "en", "bangkok": "en", "bogota": "es",
    "buenos aires": "es", "cape town": "en", "chennai": "en", "chiang mai": "en",
    "chicago": "en", "delhi": "en", "guatemala": "es", "houston": "en",
    "johannesburg": "en", "kanpur": "en", "kigali": "en", "kinshasa": "en",
    "kolkata": "en", "london": "en", "los angeles": "en", "madrid": "es",
    "melbourne": "en", "mexico city": "es", "mumbai": "en", "nairobi": "en",
    "new york": "en", "paris": "fr", "phuket": "en", "san salvador": "es",
    "sydney": "en", "tegucigalpa": "es", "toronto": "en",
}

ACCOUNT_TYPES = [
    "media", "organizations", "policymaker", "politicians", "researcher",
    "environment", "healthcare",
]

# Zero-shot labels (the fine-tuner uses the same list without healthcare).
ZERO_SHOT_LABELS = [
    "environment or pollution",
    "environmental research",
    "politician or policymaker",
    "nonprofit organization",
    "news outlet or journalist",
    "healthcare professional",
    "other",
]
FINETUNE_LABELS = [label for label in ZERO_SHOT_LABELS if label != "healthcare professional"]

# Categories a prompt-based classifier may answer with.
PROMPT_CATEGORIES = [
    "media", "organizations", "non-profits", "policymaker", "politicians",
    "environment", "researchers", "healthcare", "other",
]

# Whole-token keywords of the list filter.
LIST_KEYWORDS = [
    "air", "pollution", "earth", "climate", "smog", "science", "research",
    "researchers", "politics", "politicians", "media", "journalists", "ngo",
    "nonprofit", "non-profits", "non profit", "humanitarian", "environment",
    "environmental",
]

# Substring keywords of the older list filter (each also as "<kw> <city>").
LIST_KEYWORDS_SUBSTRING = [
    "journalists", "journalism", "news", "politics", "ngo", "pollution", "air",
    "health", "swatchh", "clean", "climate", "energy", "environment", "activist",
]

ROOT_MIN_FOLLOWERS = 100          # a root user needs more followers than this
EXTRA_TWEETS_PER_USER = 5
CAP_FOLLOWERS, CAP_RETWEETERS, CAP_TWEETS = 1000, 500, 1000
SAMPLE_SIZE, SAMPLE_SEED = 1200, 1236
USER_URL_PREFIX = "https://twitter.com/"
# ---------------------------------------------------------------------------


def city_targets(city: str, exclude_bare: list[str] | None = EXCLUDE_BARE) -> list[str]:
    """The strings whose presence in a location means ``city``."""
    bare = [] if exclude_bare and city in exclude_bare else [city]
    return bare + [alias for alias, main in ALIASES.items() if main == city]


def lit_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


# ---------------------------------------------------------------------------
# Search templates per language and account type; the literal
# word 'location' is replaced by the city (with aliases OR-ed in the alias form).
# ---------------------------------------------------------------------------
QUERY_TEMPLATES_EN = {
    'media': '(location) (media OR press OR coverage OR broadcasting\n                OR (breaking news) OR journalism OR journalist\n                OR local OR news) -is:retweet',
    'organizations': '((NGO location) OR (organization location)\n                       OR (non-profit location) OR (location institution) OR\n                       (non-governmental organization location) OR (nonprofit location))\n                       -is:retweet',
    'policymaker': '(location) ((member of parliament) OR governor OR minister\n                    OR magistrate OR (district magistrate) OR IAS OR officer\n                    OR cabinet OR mayor OR councillor OR (local government)\n                    OR (city official) OR (MLA) OR (MP) OR government OR municipality)\n                    -is:retweet',
    'politicians': '(location) (politics OR politicians OR politician) -is:retweet',
    'researcher': '(location) ((environmental research) OR (environmental researcher)\n                    OR science OR academic OR research OR university OR professor OR\n                    postdoc OR postdoctoral OR PhD) -is:retweet',
    'environment': '(location) ((air pollution) OR pollution OR (poor air)\n                    OR asthma OR polluted OR (pollution control board)\n                    OR smog OR (air quality)) -is:retweet',
    'healthcare': '(location) (MD OR doctor OR physician OR surgeon OR cardiologist OR pulmonologist\n                                OR pediatrician OR nurse OR "healthcare professional" OR "medical expert"\n                                OR therapist OR clinician OR specialist OR pharmacist OR "medical practitioner"\n                                OR "medical doctor" OR "resident physician") -is:retweet',
}
QUERY_TEMPLATES_ES = {
    'media': 'location (media OR prensa OR periodico OR transmision\n                          OR periodismo OR periodista\n                          OR local OR noticias) -is:retweet',
    'organizations': 'location ("NGO" OR "organizacion" OR "organizaciones" OR\n                     "organizacion civil" OR "non-profit" OR "institucion" OR\n                     "sin fines de lucro" OR "non-governmental organization" OR\n                     "nonprofit") -is:retweet',
    'policymaker': 'location (gobernador OR ministro OR magistrado OR diputado\n                    OR senador OR gabinete OR (gobierno local) OR gobierno OR\n                    municipio OR delegacion OR ministerio OR legislador OR legisladores\n                    OR legislacion OR legisladora) -is:retweet',
    'politicians': 'location (politica OR politicos OR politico OR politicas)\n                      -is:retweet',
    'researcher': 'location ((investigacion ambiental) OR (investigador ambiental)\n                    OR (investigadora ambiental) OR ciencia OR academico\n                    OR academica OR investigacion OR universidad OR profesor\n                    OR postdoc OR postdoctoral OR PhD OR doctorado OR investigador\n                    OR investigadora OR universitario OR universitaria)\n                    -is:retweet',
    'environment': 'location ((contaminacion del aire) OR contaminacion OR\n                    (salud publica) OR asma OR contaminado OR contaminada\n                    OR smog OR (calidad del aire) OR (medio ambiente))\n                    -is:retweet',
    'healthcare': 'location ((doctor OR doctora OR medico OR medica OR cirujano OR cirujana OR cardiologo\n                    OR cardiologa OR neumologo OR neumologa OR pediatra OR enfermera OR enfermero\n                    OR (profesional de la salud) OR terapeuta OR clinico OR clinica OR farmaceutico\n                    OR neumologo OR (médico residente))\n                    -is:retweet',
}
QUERY_TEMPLATES_FR = {
    'media': 'location (média OR presse OR couverture OR diffusion\n                OR (flash info) OR journalisme OR journaliste\n                OR local OR actualités)\n                -is:retweet',
    'organizations': '((ONG location) OR (organisation location)\n                       OR (non lucratif location) OR (location institution) OR\n                       (organisation non gouvernementale location) OR (non lucratif location))\n                       -is:retweet',
    'policymaker': 'location ((membre du parlement) OR gouverneur OR ministre\n                    OR magistrat OR (magistrat de district) OR IAS OR officier\n                    OR cabinet OR maire OR conseiller municipal OR (gouvernement local)\n                    OR (fonctionnaire municipal) OR (MLA) OR (député) OR gouvernement OR municipalité)\n                    -is:retweet',
    'politicians': 'location (politique OR politiciens OR politicien)\n                      -is:retweet',
    'researcher': 'location ((recherche environnementale) OR (chercheur environnemental)\n                    OR science OR universitaire OR recherche OR université OR professeur OR\n                    postdoc OR postdoctoral OR doctorat)\n                    -is:retweet',
    'environment': "location ((pollution de l'air) OR pollution OR (santé publique)\n                OR (air de mauvaise qualité) OR asthme OR pollué OR (commission de contrôle de la pollution)\n                OR smog OR (qualité de l'air)) -is:retweet",
    'healthcare': 'location ((MD OR médecin OR docteur OR docteure OR chirurgien OR chirurgienne OR cardiologue\n                OR pneumologue OR pédiatre OR infirmier OR infirmière OR (professionnel de santé) OR thérapeute\n                OR clinicien OR clinicienne OR spécialiste OR pharmacien OR pharmacie OR (praticien médical)\n                OR (médecin résident))\n                -is:retweet',
}
QUERY_TEMPLATES = {"en": QUERY_TEMPLATES_EN, "es": QUERY_TEMPLATES_ES, "fr": QUERY_TEMPLATES_FR}
