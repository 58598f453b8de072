"""The vocabulary, genre ids, rarity weights and grounding keywords, as constants and as small tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values, version t01: names, ids and weights that results depend on.
VERSION = "t01"
PRIMARY = ["Action", "Adventure", "Animation", "Comedy", "Crime", "Documentary", "Drama", "Family", "Fantasy", "History", "Horror", "Music", "Mystery", "Romance", "Science Fiction", "Thriller", "War", "Western"]
SUBGENRES = [
    "Romantic Comedy", "Action Comedy", "Horror Comedy", "Dark Comedy", "Crime Comedy", "Crime Thriller", "Action Thriller", "Psychological Thriller", "Legal/Courtroom Drama", "Medical Drama",
    "Romantic Drama", "War Drama", "Historical/Period Drama", "Sci-Fi Horror", "Sci-Fi Action", "Fantasy Adventure", "Neo-Noir", "Supernatural Horror", "Coming-of-Age",
]
THEMATIC = [
    "Police Procedural", "Heist", "Serial Killer", "Spy/Espionage", "Assassin/Hitman", "Time Travel", "Cyberpunk", "Dystopian/Post-Apocalyptic", "Zombie", "Slasher", "Vampire", "Werewolf/Monster",
    "Superhero", "Mockumentary", "Whodunit/Murder Mystery", "Biopic", "Disaster", "Sports", "Martial Arts", "Prison", "Road Movie", "Survival", "Political", "Musical", "Narco", "Giallo",
    "Hong Kong Action", "Samurai", "Telenovela",
]
REGIONAL = ["Nordic Noir", "K-Drama", "Korean Thriller", "British Crime", "French Cinema", "Italian Cinema", "Spanish-language Thriller", "Latin American", "Turkish Drama", "Bollywood/Hindi", "Scandinavian", "J-Horror", "German Cinema"]
MOODS = ["Slow-burn", "Feel-good", "Mind-bending", "Cozy", "Dark & Gritty", "Wholesome", "Tearjerker", "Tense/Edge-of-seat", "Quirky/Offbeat", "Visually-stunning", "Twist-ending", "Bingeable", "Comfort-watch", "Thought-provoking"]
MOVIE_GENRES = {
    28: "Action", 12: "Adventure", 16: "Animation", 35: "Comedy", 80: "Crime", 99: "Documentary", 18: "Drama", 10751: "Family", 14: "Fantasy", 36: "History", 27: "Horror", 10402: "Music",
    9648: "Mystery", 10749: "Romance", 878: "Science Fiction", 10770: "TV Movie", 53: "Thriller", 10752: "War", 37: "Western",
}
TV_GENRES = {
    10759: "Action & Adventure", 16: "Animation", 35: "Comedy", 80: "Crime", 99: "Documentary", 18: "Drama", 10751: "Family", 10762: "Kids", 9648: "Mystery", 10763: "News", 10764: "Reality",
    10765: "Sci-Fi & Fantasy", 10766: "Soap", 10767: "Talk", 10768: "War & Politics", 37: "Western",
}
RARITY = {
    "Drama": 0.50, "Comedy": 0.65, "Action": 0.85, "Thriller": 0.90, "Adventure": 1.00, "Romance": 1.00, "Science Fiction": 1.10, "Fantasy": 1.15, "Family": 1.15, "Horror": 1.20,
    "Animation": 1.20, "Mystery": 1.25, "Crime": 1.35, "Documentary": 1.45, "History": 1.45, "Music": 1.55, "War": 1.55, "Western": 1.85,
}
GROUNDING = {
    "police procedural": [268067, 15167, 6149], "heist": [10051], "serial killer": [10714], "spy & espionage": [5265, 236615], "assassin & hitman": [782, 177964], "time travel": [4379],
    "cyberpunk": [12190], "zombie": [12377, 186565], "slasher": [12339], "superhero": [9715], "post-apocalyptic": [4458, 4565], "coming-of-age": [10683],
    "courtroom & legal": [214780, 222517, 254459, 33519], "martial arts": [779, 780, 9917], "biopic": [9672], "mockumentary": [11800], "spy/espionage": [5265, 236615],
    "assassin/hitman": [782, 177964],
}
ANIME_KEYWORD, ANIMATION_GENRE = 210024, 16
MEDIA = {"movie": "Movie", "tv": "Series", "person": "Person"}


def vocabulary(spark: SparkSession, subgenre: float = 0.70, thematic: float = 0.55, mood: float = 0.60) -> DataFrame:
    """axis, ord, label, family, threshold. Labels of the regional axis can't be assigned and have no threshold."""
    rows = [(axis, i, label, family, cut) for axis, labels, family, cut in (("primary", PRIMARY, None, None), ("subgenres", SUBGENRES, "subgenres", subgenre), ("subgenres", THEMATIC, "thematic", thematic), ("regional", REGIONAL, "regional", None), ("moods", MOODS, "moods", mood)) for i, label in enumerate(labels)]
    return spark.createDataFrame(rows, "axis string, ord int, label string, family string, threshold double")


def genre_names(spark: SparkSession) -> DataFrame:
    rows = [(media, i, name) for media, names in (("movie", MOVIE_GENRES), ("tv", TV_GENRES)) for i, name in names.items()]
    return spark.createDataFrame(rows, "media_type string, genre_id bigint, genre string")


def rarity(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(RARITY.items()), "genre string, weight double")


def grounding(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(GROUNDING.items()), "grounds string, keyword_ids array<bigint>")
