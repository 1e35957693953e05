"""Word and caption functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word lists.
CONNECTORS = ("the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "is", "are", "was", "were", "it", "my", "your", "i", "we", "he", "she", "they", "so", "if", "no", "not", "just", "with")
CONNECTORS_WITH_ROLES = ("the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "is", "are", "was", "were", "it", "my", "your")
EMOTIONAL = ("love", "heart", "soul", "pain", "fire", "light", "dark", "dream", "lost", "broken", "beauty", "forever", "silence", "truth", "faith", "hope", "fear", "cry", "tears", "blood", "death", "life", "alone", "free", "breathe", "burn", "fall", "fly", "rise", "shine", "shadow", "ghost", "memory", "heaven", "hell", "angel", "demon", "wild", "infinite", "eternity", "desire", "touch", "kiss", "whisper", "scream", "echo", "flame")
# Font sizes by words of a line, (up to, size).
FONT_TIERS = {"beat": ((4, 96), (7, 72), (None, 56)), "scatter": ((4, 88), (7, 68), (None, 52)), "wipe": ((5, 80), (8, 64), (None, 52)), "fly": ((3, 96), (5, 80), (None, 64))}
# Transition and seconds by section pair, first match first; None is any.
TRANSITIONS = (("verse", "verse", "dissolve", 1.0), ("verse", "chorus", "none", 0.0), ("chorus", "chorus", "none", 0.0), ("chorus", "verse", "fadeblack", 0.8), (None, "bridge", "dissolve", 1.2), ("bridge", None, "dissolve", 1.0), (None, None, "dissolve", 0.8))

# Caption styles and the head of a subtitle document.
CAPTION_STYLES = {
    "karaoke": {"name": "Karaoke", "font": "Arial Black", "size": 72, "primary": "&H00FFFFFF", "secondary": "&H0000D7FF", "outline": "&H00000000", "back": "&H80000000", "bold": -1, "outline_width": 3, "shadow": 2, "alignment": 2, "margin_v": 60, "spacing": 2},
    "neon": {"name": "NeonKaraoke", "font": "Helvetica Neue", "size": 68, "primary": "&H00FFFFFF", "secondary": "&H0000FF00", "outline": "&H00FF8800", "back": "&H40000000", "bold": -1, "outline_width": 4, "shadow": 3, "alignment": 2, "margin_v": 80, "spacing": 3},
    "minimal": {"name": "MinimalKaraoke", "font": "Inter", "size": 64, "primary": "&H80FFFFFF", "secondary": "&H00FFFFFF", "outline": "&H00000000", "back": "&H60000000", "bold": 0, "outline_width": 2, "shadow": 1, "alignment": 2, "margin_v": 50, "spacing": 4},
}
ASS_HEAD = """[Script Info]
Title: Karaoke Subtitles
ScriptType: v4.00+
WrapStyle: 0
ScaledBorderAndShadow: yes
YCbCr Matrix: TV.709
PlayResX: 1920
PlayResY: 1080

[V4+ Styles]
Format: Name, Fontname, Fontsize, PrimaryColour, SecondaryColour, OutlineColour, BackColour, Bold, Italic, Underline, StrikeOut, ScaleX, ScaleY, Spacing, Angle, BorderStyle, Outline, Shadow, Alignment, MarginL, MarginR, MarginV, Encoding
Style: {name},{font},{size},{primary},{secondary},{outline},{back},{bold},0,0,0,100,100,{spacing},0,1,{outline_width},{shadow},{alignment},40,40,{margin_v},1

[Events]
Format: Layer, Start, End, Style, Name, MarginL, MarginR, MarginV, Effect, Text
"""


def normalised(word: Column) -> Column:
    """F1 [R]: lower case without anything but letters, digits, underscores and blanks."""
    return F.trim(F.regexp_replace(F.lower(word), r"[^\p{L}\p{N}_\s]", ""))


def normalised_words(words: Column) -> Column:
    """F1 of each word of a list, found in all of its words at once. Words hold no blanks."""
    text = F.regexp_replace(F.lower(F.concat(F.array_join(words, " "), F.lit(" "))), r"[^\p{L}\p{N}_\s]", "")
    return F.slice(F.split(text, " "), 1, F.size(words))


def letters_of_words(words: Column) -> Column:
    """Letters a-z in lower case of each word of a list, found in all of its words at once. Words hold no blanks."""
    return F.split(F.regexp_replace(F.lower(F.array_join(words, " ")), "[^a-z ]", ""), " ")


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"\s+"), lambda x: x != ""))


def prompt_ok(text: Column, least: int = 15, most: int = 40) -> Column:
    """F7 [D]: a motion prompt has 15 to 40 words."""
    return word_count(text).between(least, most)


def ass_time(seconds: Column) -> Column:
    """X1 [R]: H:MM:SS.cc, hundredths cut off."""
    rest = seconds % 60
    return F.format_string("%d:%02d:%02d.%02d", F.floor(seconds / 3600), F.floor(seconds % 3600 / 60), F.floor(rest), F.floor((rest - F.floor(rest)) * 100))


def karaoke(words: Column) -> Column:
    """X2 [R]: timed words (start_s, end_s, word) as karaoke tags; each lasts a hundredth at least."""
    return F.array_join(F.transform(words, lambda w, i: F.concat(
        F.lit("{\\kf"), F.greatest(F.lit(1), ((w["end_s"] - w["start_s"]) * 100).cast("int")).cast("string"), F.lit("}"), F.when(i > 0, " ").otherwise(""), w["word"])), "")


def letters(word: Column) -> Column:
    return F.when(word == "", F.array().cast("array<string>")).otherwise(F.split(word, ""))


def reveal_times(word: Column, start: Column, end: Column, last: Column) -> Column:
    """X6 [R]: (char, t) of each letter of a word, and of the no-break space after it unless it is the last of its line."""
    chars = F.filter(F.split(word, ""), lambda c: c != "")
    step = (end - start) / F.greatest(F.size(chars), F.lit(1))
    typed = F.transform(chars, lambda c, i: F.struct(c.alias("char"), (start + i * step).alias("t")))
    return F.concat(typed, F.when(last, F.array().cast("array<struct<char:string,t:double>>")).otherwise(F.array(F.struct(F.lit("\u00a0").alias("char"), end.alias("t")))))


def font_size(words: Column, template: str) -> Column:
    """X9 [R]: font size of a line by its number of words."""
    out = None
    for upto, size in reversed(FONT_TIERS[template]):
        out = F.lit(size) if upto is None else F.when(words <= upto, size).otherwise(out)
    return out


def transition(before: Column, after: Column) -> tuple[Column, Column]:
    """X11 [R]: kind and seconds of the transition between two sections; the first rule that fits."""
    kind, secs = F.lit(None), F.lit(None)
    for a, b, k, s in reversed(TRANSITIONS):
        fits = (F.lit(True) if a is None else before == a) & (F.lit(True) if b is None else after == b)
        kind, secs = F.when(fits, k).otherwise(kind), F.when(fits, s).otherwise(secs)
    return kind, secs


def amplitude(bpm: Column) -> tuple[Column, Column]:
    """X16 [D]: zoom and flash by tempo; the bands are read as < 100, [100, 140), [140, 170], > 170."""
    return F.when(bpm < 140, 0.03).when(bpm <= 170, 0.018).otherwise(0.012), F.when(bpm < 140, 0.2).when(bpm <= 170, 0.12).otherwise(0.08)
