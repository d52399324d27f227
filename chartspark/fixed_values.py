"""Values that decide the results; the code around them is generic and takes them as parameters."""

# --- Fixed values: they have to be exactly these for the results to be right. ---

# (code, country, continent)
COUNTRIES = [
    ("US", "United States", "America"),
    ("CA", "Canada", "America"),
    ("MX", "Mexico", "America"),
    ("BR", "Brazil", "America"),
    ("AR", "Argentina", "America"),
    ("GB", "United Kingdom", "Europe"),
    ("DE", "Germany", "Europe"),
    ("FR", "France", "Europe"),
    ("IT", "Italy", "Europe"),
    ("ES", "Spain", "Europe"),
    ("NG", "Nigeria", "Africa"),
    ("ZA", "South Africa", "Africa"),
    ("EG", "Egypt", "Africa"),
    ("IN", "India", "Asia"),
    ("ID", "Indonesia", "Asia"),
]

# Ordered: the first genre with a keyword inside the tag wins.
GENRE_RULES = [
    ("World Music", ["mahraganat", "shaabi", "egyptian alternative", "amapiano", "afrobeats"]),
    ("Pop", ["pop", "new romantic", "disco", "neo", "easy", "adult standards", "dance", "reggaeton",
             "funk", "bollywood"]),
    ("Rock", ["rock", "punk", "grunge", "punk blues", "permanent wave", "metal"]),
    ("Hip-Hop", ["rap", "hip", "hop", "drill"]),
    ("Country", ["country", "americana", "corrido", "sierreno", "chihuahuense", "norteno", "ranchera",
                 "tejano", "sertanejo", "tex mex", "regional mexican", "banda", "duranguense", "grupero"]),
    ("Electronic", ["electronic", "electro", "indietronica", "shoegaze", "french touch", "french house",
                    "filter house", "indie", "bassline", "edm", "techno", "house", "dubstep", "gaming"]),
    ("Folk", ["folk", "maskandi", "forro", "vaqueiro"]),
    ("Jazz", ["jazz"]),
    ("Blues", ["blues"]),
    ("Latin", ["reggaeton", "latin", "salsa", "tango", "flamenco", "samba", "bossa nova", "urbano"]),
    ("Soul", ["soul", "motown", "r&b"]),
]

# Ordered: the first genre that lists the tag, letter for letter, wins.
TAG_RULES = [
    ("Pop", ["pop", "dance-pop", "synthpop", "alt-pop", "indie pop", "Progressive Pop", "art pop",
             "electropop", "chamber pop", "baroque pop"]),
    ("Rock", ["pop rock", "indie rock", "psychedelic pop", "alternative rock"]),
    ("Hip-Hop", ["hip hop", "Hip-Hop", "trap", "rap"]),
    ("Country", ["country", "country pop", "americana", "bro-country"]),
    ("Soul", ["soul", "alternative rnb", "rnb"]),
    ("Electronic", ["indietronica", "deep house", "dubstep"]),
    ("Folk", ["folk pop", "singer-songwriter"]),
    ("New Wave", ["new wave", "coldwave"]),
]

DEFAULT_GENRE = "Unidentified"
GENRE_TAGS_READ = 5

UNWANTED_KEYWORDS = ["Remaster", "Live", "Edition", "Instrumental", "Radio Edit", "Acoustic"]

ML_FEATURES = ["acousticness", "danceability", "energy", "instrumentalness", "liveness", "loudness",
               "speechiness", "tempo", "valence", "energy_efficiency", "emotional_impact"]
ML_CLUSTERS = 7
ML_SEED = 42
ELBOW_RANGE = (2, 20)

CHART_SIZE = 50
LOOKUP_BATCH = 50
PUBLISH_FLOOR = 500
VIRAL_DAYS = 14
CATEGORY_BOUNDS = (33, 66)

# What Unicode calls white space and str.split() splits on.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)

# --- End of the fixed values. ---
