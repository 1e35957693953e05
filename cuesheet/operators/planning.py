"""Plans, costs and look-ups of a project."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .asof import nearest

# Prices in dollars.
IMAGE, PER_SECOND, FLAT = 0.04, {"kling-3.0-pro": 0.112, "kling-3.0-standard": 0.084, "kling-2.6-pro": 0.07}, 0.59
# Genre: frames a second, caption template, effects on by default.
GENRES = {"pop": (30, "beat-pulse", None), "hip-hop": (24, "text-slam", True), "rock": (24, "split-scatter", None), "edm": (30, "beat-pulse", True), "r&b": (24, "gradient-wipe", None), "indie": (24, "stacked-emphasis", None), "country": (24, "bold-centered", None)}
# Least and most scenes of a section, seconds of a scene.
SCENES, SCENE_SECONDS = {"intro": (1, 2), "outro": (1, 2), "verse": (2, 4), "chorus": (2, 4), "bridge": (1, 2)}, 5.0
SCALES = ("wide", "medium", "close-up")


# Genre: palette, lighting, locations, camera.
LOOKS = {
    "pop": ("Bright, saturated, clean", "Even, polished", "Fashion-forward, varied", "Steady, smooth tracking"),
    "hip-hop": ("High-contrast, neon accents", "Hard shadows, rim light", "Urban, nightlife, studio", "Low angles, slow-mo"),
    "rock": ("Desaturated, earthy", "Harsh, practical", "Warehouses, stages, outdoors", "Handheld feel, fast cuts"),
    "edm": ("Neon, hyper-saturated", "Strobes, colored gels", "Clubs, festivals, abstract", "Dynamic, zooms, glitch"),
    "r&b": ("Warm amber, rich tones", "Soft backlight, warm", "Intimate interiors, golden hour", "Shallow DOF, close-ups"),
    "indie": ("Muted, faded, vintage", "Natural, overcast", "Nature, small towns, bedrooms", "Static, contemplative"),
    "country": ("Golden, warm earth", "Golden hour, natural", "Open fields, porches, roads", "Wide establishing shots"),
}
# Genre: narrative arc.
ARCS = {
    "pop": "Ordinary → discovery → transformation → celebration", "hip-hop": "Struggle → grind → rise → triumph",
    "rock": "Frustration → rebellion → release → aftermath", "edm": "Tension build → anticipation → drop → euphoria",
    "r&b": "Loneliness → attraction → intimacy → devotion", "indie": "Observation → introspection → realization → acceptance",
    "country": "Memory → present struggle → community/faith → peace",
}
# Section: colour temperature.
TEMPERATURES = {
    "verse 1": "Cool blues, desaturated", "chorus": "Warm amber, saturated", "verse 2": "Slightly warmer than V1",
    "bridge": "Contrasting (opposite of chorus)", "final chorus": "Golden, most saturated", "outro": "Return toward cool, fading",
}
# Mood: lighting.
MOODS = {
    "hopeful": "Golden light, open spaces, upward angles, warm tones, sunrise", "melancholic": "Rain, overcast, cool blue, solitary figures, dusk",
    "energetic": "Fast movement, bright colors, neon, dynamic angles", "intimate": "Close-ups, shallow DOF, warm interior light, soft focus",
    "defiant": "Low angles, harsh light, strong silhouettes, dramatic contrast", "nostalgic": "Film grain, warm sepia, soft focus, vintage settings",
    "ethereal": "Fog, lens flare, particles, pastel tones, water", "triumphant": "Wide epic shots, golden hour, elevated vantage, sweeping vistas",
}
# Visual element: words for it.
METAPHORS = {
    "water": ("water",), "fire": ("fire",),
    "birds/flight": ("bird", "birds", "flight"), "mirrors": ("mirror", "mirrors"),
    "rain/storms": ("rain", "storm", "storms"), "forests": ("forest", "forests"),
    "cages/walls": ("cage", "cages", "wall", "walls"), "light/dark": ("light", "dark"),
    "clocks/sand": ("clock", "clocks", "sand"), "doors/crossroads": ("door", "doors", "crossroads"),
    "broken glass": ("glass",), "red thread": ("thread",), "candle flame": ("candle", "flame"),
}


def _mapped(values: dict, key):
    return F.element_at(F.create_map(*(F.lit(x) for kv in values.items() for x in kv)), key)


def genre_defaults(songs: DataFrame) -> DataFrame:
    """J8 [D]: frame rate, caption template and effects by genre; null for an unknown genre."""
    low = F.lower("genre")
    pick = lambda i: _mapped({k: v[i] for k, v in GENRES.items() if v[i] is not None}, low)
    return songs.select("track_id", "genre", pick(0).alias("fps"), pick(1).alias("template"), F.coalesce(pick(2), F.lit(False)).alias("effects"))


def genre_looks(songs: DataFrame) -> DataFrame:
    """J8 [D]: palette, lighting, locations, camera and narrative arc by genre; null for an unknown genre."""
    low = F.lower("genre")
    looks = (_mapped({k: v[i] for k, v in LOOKS.items()}, low).alias(n) for i, n in enumerate(("palette", "lighting", "locations", "camera")))
    return songs.select("track_id", "genre", *looks, _mapped(ARCS, low).alias("arc"))


def section_temperatures(sections: DataFrame) -> DataFrame:
    """J8 [D]: colour temperature of each section; later verses are as the second, the last of several choruses is
    final; null for labels without one."""
    low = F.lower("label")
    kind = Window.partitionBy("track_id", low)
    nth, n = F.row_number().over(kind.orderBy("section_idx")), F.count("*").over(kind)
    key = F.when(low == "verse", F.when(nth == 1, "verse 1").otherwise("verse 2")).when((low == "chorus") & (n > 1) & (nth == n), "final chorus").otherwise(low)
    return sections.select("track_id", "section_idx", key.alias("key")).select("track_id", "section_idx", _mapped(TEMPERATURES, F.col("key")).alias("temperature"))


def mood_lighting(scenes: DataFrame) -> DataFrame:
    """J8 [D]: ``scenes`` with the lighting of their mood; null for an unknown mood."""
    return scenes.withColumn("mood_lighting", _mapped(MOODS, F.lower("mood")))


def theme_lexicon(spark: SparkSession, emotional: tuple[str, ...]) -> DataFrame:
    """A16 [A]: ``word, theme``: the words of each visual element, and those of emotion."""
    rows = [(w, k) for k, words in METAPHORS.items() for w in words] + [(w, "emotional") for w in emotional]
    return spark.createDataFrame(rows, "word string, theme string")


def costs(clips: DataFrame) -> DataFrame:
    """A13 [D]: cost by project and model, by project, and of all. ``clips``: project_id, model, duration."""
    each = clips.withColumn("usd", IMAGE + F.col("duration") * _mapped(PER_SECOND, F.col("model")))
    return each.rollup("project_id", "model").agg(F.count("*").alias("scenes"), F.round(F.sum("usd"), 4).alias("cost_usd"), F.round(F.count("*") * FLAT, 2).alias("review_usd"))


def review(clips: DataFrame) -> DataFrame:
    """A14 [R]: approved, pending and rejected scenes; ready if all are approved and there is one."""
    n = lambda k: F.count_if(F.col("status") == k).alias(k)
    return clips.groupBy("project_id").agg(*map(n, ("approved", "pending", "rejected")), F.count("*").alias("n")).select(
        "project_id", "approved", "pending", "rejected", ((F.col("approved") == F.col("n")) & (F.col("n") > 0)).alias("ready"))


def thumbnail(images: DataFrame) -> DataFrame:
    """T4 [D]: a project's best image, those of choruses first. ``images``: project_id, scene_no, section, score."""
    key = F.struct((F.lower("section") != "chorus").cast("int"), -F.col("score"), "scene_no")
    return images.groupBy("project_id").agg(F.min_by("scene_no", key).alias("scene_no"))


def shot_scales(scenes: DataFrame, by: str, order: str) -> DataFrame:
    """W15 [D]: wide, medium, close-up in turn."""
    nth = F.row_number().over(Window.partitionBy(by).orderBy(order)) - 1
    return scenes.withColumn("scale", F.element_at(F.array(*map(F.lit, SCALES)), (nth % 3 + 1).cast("int")))


def scene_counts(sections: DataFrame) -> DataFrame:
    """G4 [D]: scenes of each section: length over 5 s within the section's range, fewer if it is too short."""
    low = F.lower("label")
    dur = F.col("end_s") - F.col("start_s")
    lo, hi = (F.coalesce(_mapped({k: v[i] for k, v in SCENES.items()}, low), F.lit(d)) for i, d in ((0, 1), (1, 2)))
    fit = F.floor(dur / SCENE_SECONDS)
    return sections.withColumn("n_scenes", F.when(dur < lo * SCENE_SECONDS, F.greatest(F.lit(1), fit)).otherwise(F.least(F.greatest(fit, lo), hi)).cast("int"))


def scene_plan(sections: DataFrame, beats: DataFrame, songs: DataFrame) -> DataFrame:
    """G4 [D]: equal scenes of each section whose inner bounds go to the nearest beat; in songs under 60 BPM only
    every fourth beat counts. ``beats``: track_id, beat_idx, t; ``songs``: track_id, bpm."""
    slow = songs.where(F.col("bpm") < 60).select("track_id", F.lit(True).alias("slow"))
    counted = beats.join(slow, "track_id", "left").where(F.col("slow").isNull() | (F.col("beat_idx") % 4 == 0)).select("track_id", "t")
    s = scene_counts(sections)
    step = (F.col("end_s") - F.col("start_s")) / F.col("n_scenes")
    key = ["track_id", "section_idx"]
    inner = s.where("n_scenes > 1").select(*key, "start_s", "end_s", "n_scenes", F.explode(F.sequence(F.lit(1), F.col("n_scenes") - 1)).alias("i"))
    inner = nearest(inner.select(*key, "i", (F.col("start_s") + F.col("i") * step).alias("at")), counted, "track_id", "at", "bound")
    bounds = inner.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "bound"))), lambda r: r["bound"]).alias("inner"))
    s = s.join(bounds, key, "left").withColumn("all", F.concat(F.array("start_s"), F.coalesce("inner", F.array().cast("array<double>")), F.array("end_s")))
    s = s.select(*key, "label", "all", F.explode(F.sequence(F.lit(0), F.col("n_scenes") - 1)).alias("i"))
    return s.select(*key, F.col("i").alias("scene_in_section"), "label", F.get("all", F.col("i")).alias("start_s"), F.get("all", F.col("i") + 1).alias("end_s"))
