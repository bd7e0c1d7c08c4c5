"""Lists, tables and constants that results depend on."""

# Accented letters and what each becomes.
ACCENTED = "áéíóúüñ"
UNACCENTED = "aeiouun"

# Shortest normalised text and shortest token that are kept.
MIN_TEXT_LENGTH = 10
MIN_TOKEN_LENGTH = 3

# Stopwords, short list.
STOPWORDS_SHORT = [
    "el", "la", "de", "que", "y", "a", "en", "un", "ser", "se", "no",
    "por", "con", "su", "para", "como", "estar", "contrato", "servicio",
]

# Stopwords, medium list.
STOPWORDS_MEDIUM = [
    "el", "la", "de", "que", "y", "a", "en", "un", "ser", "se", "no",
    "por", "con", "su", "para", "como", "estar", "tener", "le", "lo",
    "pero", "hacer", "o", "este", "otro", "ese", "si", "ya", "ver",
    "dar", "muy", "sin", "sobre", "también", "hasta", "año", "entre",
    "del", "al", "los", "las", "uno", "una", "unos", "unas",
    "contrato", "contratos", "objeto", "prestacion", "prestación",
    "servicio", "servicios", "suministro", "ejecucion", "ejecución",
]

# Stopwords, long list (the medium list and these).
STOPWORDS_LONG = STOPWORDS_MEDIUM + [
    "acuerdo", "establecido", "pliego", "condiciones", "especificaciones",
    "entidad", "contratante", "contratista", "plazo", "termino",
]

# Department to region, the table used by the feed.
DEPARTMENT_REGION = [
    ("Distrito Capital de Bogotá", "Centro-Oriente"),
    ("Antioquia", "Eje Cafetero"),
    ("Valle del Cauca", "Pacífico"),
    ("Cundinamarca", "Centro-Oriente"),
    ("Santander", "Centro-Oriente"),
    ("Atlántico", "Gran Caribe"),
    ("Bolívar", "Gran Caribe"),
    ("Caldas", "Eje Cafetero"),
    ("Risaralda", "Eje Cafetero"),
    ("Quindío", "Eje Cafetero"),
    ("Tolima", "Eje Cafetero"),
    ("Boyacá", "Centro-Oriente"),
    ("Huila", "Centro-Oriente"),
    ("Norte de Santander", "Centro-Oriente"),
    ("Cesar", "Gran Caribe"),
    ("Córdoba", "Gran Caribe"),
    ("La Guajira", "Gran Caribe"),
    ("Magdalena", "Gran Caribe"),
    ("Sucre", "Gran Caribe"),
    ("Cauca", "Pacífico"),
    ("Chocó", "Pacífico"),
    ("Nariño", "Pacífico"),
]

# Departments that only the written specification places, and one other spelling.
DEPARTMENT_REGION_MORE = [
    ("Archipiélago de San Andrés, Providencia y Santa Catalina", "Gran Caribe"),
    ("Arauca", "Orinoquía"),
    ("Casanare", "Orinoquía"),
    ("Meta", "Orinoquía"),
    ("Vichada", "Orinoquía"),
    ("Amazonas", "Amazonía"),
    ("Caquetá", "Amazonía"),
    ("Guainía", "Amazonía"),
    ("Guaviare", "Amazonía"),
    ("Putumayo", "Amazonía"),
    ("Vaupés", "Amazonía"),
    ("Bogotá D.C.", "Centro-Oriente"),
]
UNKNOWN_REGION = "Desconocida"

# Payment codes.
PAYMENT_NAMES = [
    (0, "Desconocido"),
    (1, "Tarjeta de Crédito"),
    (2, "Efectivo"),
    (3, "Sin Cargo"),
    (4, "Disputa"),
    (5, "Vacío"),
    (6, "Nulo"),
]

# Words that stand for "not given" in duration and year fields.
BLANK_DURATION_WORDS = ["", "no d", "no definido", "nd", "sin definir"]
BLANK_YEAR_WORDS = ["", "no d", "no definido", "nd"]
DEFAULT_YEAR = 2024

# Columns dropped on the way from bronze to silver.
REDUNDANT_COLUMNS = [
    "id_interno_sistema", "campo_vacio", "constante_1",
    "constante_2", "duplicate_id", "timestamp_carga",
]

# Anomaly rule.
SIGMA_MULTIPLIER = 2.8
SEVERITY_LIMITS = [2.8, 3.5, 4.5]
SEVERITY_NAMES = ["NORMAL", "LEVE", "MODERADO", "SEVERO"]
FLAGGED = "ATIPICO"
NOT_FLAGGED = "LIBRE"

# Encoding, split and selection parameters.
SMOOTHING = 50
TRAIN_SHARE = 0.8
QUANTILE_ERROR = 0.01
MIN_CORRELATION = 0.05
VARIANCE_TARGET = 0.95

# Quality gate.
GATE_MIN_ROWS = 10_000
GATE_MIN_VALID_SHARE = 0.95

# Model parameters.
WORD2VEC = {"vectorSize": 100, "minCount": 2, "maxIter": 10, "seed": 42}
FOREST = {"numTrees": 30, "maxDepth": 8, "maxBins": 32, "subsamplingRate": 0.8, "seed": 42}
LINEAR = {"maxIter": 100, "regParam": 0.1, "elasticNetParam": 0.8}
LOGISTIC = {"maxIter": 10}
KMEANS = {"k": 4, "seed": 42}
