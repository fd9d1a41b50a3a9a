"""Fixed values of the data model: columns, ranges, taxonomy, keywords, playlists.

Everything in this module is a constant that results depend on.  Nothing here
touches Spark except the reader schema.
"""

from __future__ import annotations

from pyspark.sql import types as T

SEED = 42
TARGET = "track_genre"
ID_COLUMNS = ["track_id", "artists", "album_name", "track_name"]
BOOL_COLUMN = "explicit"

# Model input columns, in the order every fitted model expects.
FEATURES = [
    "popularity", "duration_ms", "explicit", "danceability", "energy",
    "key", "loudness", "mode", "speechiness", "acousticness",
    "instrumentalness", "liveness", "valence", "tempo", "time_signature",
]

# Derived columns, in output order after the model inputs.
ENGINEERED = [
    "log1p_speechiness", "log1p_acousticness", "log1p_instrumentalness", "log1p_liveness",
    "duration_min", "log_duration_ms", "abs_loudness", "loudness_norm",
    "energy_x_not_acoustic", "dance_x_energy", "valence_x_energy", "valence_x_dance",
    "speech_x_not_acoustic", "instrumental_x_energy", "loudness_per_energy", "pop_x_dance",
    "acoustic_x_valence", "tempo_sq", "popularity_sq", "energy_sq", "acousticness_sq",
    "instrumentalness_sq", "tempo_norm", "tempo_slow", "tempo_fast", "key_x_mode",
    "liveness_ratio",
]

# Features whose values are codes rather than measurements.
DISCRETE_FEATURES = ["explicit", "key", "mode", "time_signature"]

# Columns that are winsorised, and the fence width in IQRs.
CLIP_FEATURES = [
    "duration_ms", "tempo", "loudness", "speechiness", "acousticness",
    "instrumentalness", "liveness",
]
IQR_MULTIPLIER = 3.0

# Columns averaged per class in the group profile.
PROFILE_FEATURES = [
    "acousticness", "energy", "danceability", "speechiness",
    "loudness", "valence", "tempo", "instrumentalness",
]

# Feature -> (min, max, default).
FEATURE_DOMAIN = {
    "popularity": (0, 100, 50),
    "duration_ms": (0, 600000, 210000),
    "explicit": (0, 1, 0),
    "danceability": (0.0, 1.0, 0.6),
    "energy": (0.0, 1.0, 0.7),
    "key": (0, 11, 5),
    "loudness": (-60.0, 0.0, -7.0),
    "mode": (0, 1, 1),
    "speechiness": (0.0, 1.0, 0.05),
    "acousticness": (0.0, 1.0, 0.2),
    "instrumentalness": (0.0, 1.0, 0.0),
    "liveness": (0.0, 1.0, 0.12),
    "valence": (0.0, 1.0, 0.5),
    "tempo": (0.0, 250.0, 120.0),
    "time_signature": (1, 7, 4),
}

# Split shares, subsample and fold sizes, quality target.
VAL_RATIO = 0.15
TEST_RATIO = 0.15
CV_SUBSAMPLE = 10_000
CV_FOLDS = 3
SEARCH_TRIALS = 50
TARGET_ACCURACY = 0.80
TOP_CLASSES = 5

# Gates and name keywords of target discovery.
TARGET_MIN_CLASSES = 2
TARGET_MAX_UNIQUE_FRACTION = 0.50
TARGET_MIN_CLASS_ROWS = 10
TARGET_NAME_KEYWORDS = [
    "genre", "mood", "label", "category", "class", "tag", "emotion", "sentiment", "style",
]

# The raw labels of every class, alphabetical.
TAXONOMY = {
    "acoustic": [
        "acoustic", "ambient", "bluegrass", "blues", "chill", "classical", "country",
        "folk", "groove", "guitar", "honky-tonk", "jazz", "new-age", "opera", "piano",
        "romance", "sad", "singer-songwriter", "sleep", "songwriter", "study",
    ],
    "alternative": [
        "alt-rock", "alternative", "british", "garage", "grunge", "hard-rock", "indie",
        "indie-pop", "psych-rock", "rock", "rock-n-roll", "rockabilly",
    ],
    "dance": [
        "afrobeat", "anime", "brazil", "cantopop", "dance", "dancehall", "disco", "dub",
        "forro", "french", "funk", "german", "gospel", "happy", "indian", "iranian",
        "j-dance", "j-idol", "j-pop", "j-rock", "k-pop", "latin", "latino", "malay",
        "mandopop", "mpb", "pagode", "party", "pop", "pop-film", "power-pop", "r-n-b",
        "reggae", "reggaeton", "salsa", "samba", "sertanejo", "ska", "soul", "spanish",
        "swedish", "synth-pop", "tango", "turkish", "world-music",
    ],
    "electronic": [
        "breakbeat", "chicago-house", "club", "deep-house", "detroit-techno",
        "drum-and-bass", "dubstep", "edm", "electro", "electronic", "hardstyle", "house",
        "idm", "minimal-techno", "progressive-house", "techno", "trance",
    ],
    "heavy": [
        "black-metal", "death-metal", "emo", "goth", "grindcore", "hardcore",
        "heavy-metal", "industrial", "metal", "metalcore", "punk", "punk-rock",
    ],
    "vocal": [
        "children", "comedy", "disney", "hip-hop", "kids", "show-tunes", "trip-hop",
    ],
}
CLASSES = sorted(TAXONOMY)
RAW_TO_CLASS = {raw: cls for cls, raws in TAXONOMY.items() for raw in raws}

# Mood keywords per class; class order decides ties.
MOOD_KEYWORDS = {
    "acoustic": [
        "calm", "relax", "peaceful", "quiet", "sad", "melanchol", "nostalgic", "soft",
        "gentle", "cozy", "study", "sleep", "meditat", "slow", "folk", "piano",
        "acoustic", "rain", "coffee", "morning", "tired", "lonely", "reflective",
        "introspective", "mellow", "serene", "down", "blue", "tearful", "heartbroken",
        "chill out",
    ],
    "alternative": [
        "indie", "angs", "creative", "complex", "road trip", "driving", "grunge",
        "different", "unique", "arty", "layered", "bittersweet", "restless",
        "searching", "alternative", "edgy", "guitar", "rock",
    ],
    "dance": [
        "happy", "party", "danc", "fun", "excit", "celebrat", "joyful", "upbeat",
        "euphoric", "summer", "tropical", "pop", "positive", "good vibes", "jumping",
        "moving", "groove", "bouncy", "festive", "wedding", "birthday", "smile",
        "giddy", "cheerful",
    ],
    "electronic": [
        "focus", "work", "gaming", "club", "night", "rave", "techno", "edm", "house",
        "beat", "bass", "electric", "productive", "concentrate", "running", "synth",
        "workout", "exercise",
    ],
    "heavy": [
        "angry", "intense", "powerful", "aggressive", "motivat", "pump", "metal",
        "hard", "strong", "rage", "gym", "beast", "hardcore", "scream", "loud",
        "furious", "adrenaline", "fired up", "frustrated", "lift", "sprint",
    ],
    "vocal": [
        "rap", "hip hop", "hiphop", "lyric", "word", "story", "flow", "verse", "spoken",
        "poetic", "r&b", "rnb", "soul", "express", "rhyme", "bars", "freestyle", "trap",
        "expressive",
    ],
}
MOOD_DEFAULT = "dance"

# Canned mood texts.
QUICK_MOODS = [
    "I'm feeling happy and upbeat",
    "I'm feeling sad and a bit down",
    "I'm feeling energetic and pumped",
    "I want something calm and relaxing",
    "I'm feeling intense and motivated",
    "I want something lyric-heavy and expressive",
    "I'm feeling moody and introspective",
    "I want to dance and celebrate",
]

# Tagline per class.
TAGLINES = {
    "acoustic": "Warm, quiet, and real",
    "alternative": "Moody, layered, and raw",
    "dance": "Feel it in your feet",
    "electronic": "Pure energy, no lyrics needed",
    "heavy": "Loud and unapologetically so",
    "vocal": "The words are the music",
}

# Playlists per class, in display order: (name, description, search query).
PLAYLISTS = {
    "acoustic": [
        ("Peaceful Piano", "Soft instrumentals for quiet moments", "peaceful piano ambient playlist"),
        ("Coffee Shop Acoustic", "Gentle singer-songwriter for slow mornings", "coffee shop acoustic playlist"),
        ("Deep Focus", "Ambient sounds to help you concentrate", "deep focus study ambient playlist"),
        ("Rainy Day Folk", "Folk and country for grey, reflective days", "rainy day folk acoustic playlist"),
    ],
    "alternative": [
        ("Indie Essentials", "The best of indie rock and dream pop", "indie rock essentials playlist"),
        ("90s Alt Rock", "Grunge and alternative classics", "90s alternative grunge rock playlist"),
        ("Road Trip Rock", "Guitar-driven tracks for the open road", "road trip rock driving playlist"),
        ("Psychedelic Haze", "Layered, hazy, and hypnotic", "psychedelic rock playlist"),
    ],
    "dance": [
        ("Today's Top Hits", "The biggest pop tracks right now", "todays top hits pop playlist"),
        ("Summer Vibes", "Sun-drenched latin pop and tropical beats", "summer latin pop vibes playlist"),
        ("Party Anthems", "High-energy dance floor bangers", "party anthems dance floor playlist"),
        ("K-Pop Central", "Irresistible K-Pop and J-Pop hits", "kpop jpop hits playlist"),
    ],
    "electronic": [
        ("Electronic Focus", "Deep house and ambient for concentration", "electronic focus deep house playlist"),
        ("Late Night EDM", "Festival-ready drops and big room sets", "late night edm festival playlist"),
        ("Synthwave Drive", "Retro-future synths for night drives", "synthwave retrowave night drive playlist"),
        ("Drum and Bass", "High-tempo breaks and rolling basslines", "drum and bass dnb playlist"),
    ],
    "heavy": [
        ("Metal Classics", "The definitive heavy metal hall of fame", "metal classics rock playlist"),
        ("Gym Fuel", "Hard rock and metal for maximum effort", "gym workout metal rock playlist"),
        ("Punk Rush", "Fast, loud, and over in three minutes", "punk rock energy playlist"),
        ("Modern Metal", "New-wave metal and heavy alternative", "modern metal heavy alternative playlist"),
    ],
    "vocal": [
        ("Hip-Hop Essentials", "The tracks that defined the genre", "hip hop rap essentials playlist"),
        ("Lofi Hip-Hop", "Lo-fi beats and laid-back flows", "lofi hip hop chill beats playlist"),
        ("R&B Mood", "Smooth soul for late evenings", "rnb soul mood playlist"),
        ("Lyrical Bars", "Wordsmiths and storytellers at their best", "lyrical rap storytelling playlist"),
    ],
}
TRACK_URL_PREFIX = "https://open.spotify.com/track/"
SEARCH_URL_PREFIX = "https://open.spotify.com/search/"

# Column types of the raw track file, in file order after the index column.
TRACK_SCHEMA = T.StructType([
    T.StructField("track_id", T.StringType()),
    T.StructField("artists", T.StringType()),
    T.StructField("album_name", T.StringType()),
    T.StructField("track_name", T.StringType()),
    T.StructField("popularity", T.IntegerType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("explicit", T.BooleanType()),
    T.StructField("danceability", T.DoubleType()),
    T.StructField("energy", T.DoubleType()),
    T.StructField("key", T.IntegerType()),
    T.StructField("loudness", T.DoubleType()),
    T.StructField("mode", T.IntegerType()),
    T.StructField("speechiness", T.DoubleType()),
    T.StructField("acousticness", T.DoubleType()),
    T.StructField("instrumentalness", T.DoubleType()),
    T.StructField("liveness", T.DoubleType()),
    T.StructField("valence", T.DoubleType()),
    T.StructField("tempo", T.DoubleType()),
    T.StructField("time_signature", T.IntegerType()),
    T.StructField("track_genre", T.StringType()),
])
INDEX_COLUMN = "_row_id"
