"""Column functions over text: tokens, windows, quality, scripts, names, dates, citations, kinds, roles. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tokens(text) -> Column:
    """Lower-cased runs of ASCII letters, or of digits with trailing letters. Null gives null, '' an empty array."""
    return F.transform(F.regexp_extract_all(c(text), F.lit("([A-Za-z]+|[0-9]+[A-Za-z]*)"), F.lit(1)), F.lower)


def approximate_tokens(text) -> Column:
    return (F.floor(F.length(c(text)) / 4) + 1).cast("bigint")


def indexed_text(prefix, text) -> Column:
    """Prefix, a blank line and text, trimmed; text alone where the prefix is blank or null."""
    p = F.trim(c(prefix))
    return F.when(p != "", F.trim(F.concat(p, F.lit("\n\n"), c(text)))).otherwise(c(text))


def closing_window(text, share: float, least: int, most: int) -> Column:
    """The last `share` of a text, at least `least` and at most `most` characters."""
    n = F.least(F.lit(most), F.greatest(F.lit(least), F.floor(F.length(c(text)) * share).cast("int")))
    return F.substring(c(text), F.greatest(F.lit(1), F.length(c(text)) - n + 1), n)


ARABIC = "[\\u0600-\\u06FF\\u0750-\\u077F\\uFB50-\\uFDFF\\uFE70-\\uFEFC]"


def script_of(text) -> Column:
    """(script, direction): Arab/rtl, Latn/ltr, both Zyyy/mixed, neither Zyyy/ltr."""
    arab, latin = c(text).rlike(ARABIC), c(text).rlike("[A-Za-z]")
    script = F.when(arab & ~latin, "Arab").when(latin & ~arab, "Latn").otherwise("Zyyy")
    return F.struct(script.alias("script"), F.when(arab & latin, "mixed").when(arab, "rtl").otherwise("ltr").alias("direction"))


# The kinds of sensitive content and how they are printed.
SENSITIVE = {
    "national_id": "[0-9]{5}-[0-9]{7}-[0-9]",
    "mobile": "(^|[^0-9])03[0-9]{2}-?[0-9]{7}([^0-9]|$)",
    "medical": "(?i)\\b(post-mortem|medico-legal|hospital|injury|dna)\\b",
    "victim": "(?i)\\b(victim|prosecutrix|rape|minor girl)\\b",
}


def sensitivity(text) -> Column:
    """The names of the sensitive patterns a text holds, in fixed order."""
    return F.array_compact(F.array(*[F.when(c(text).rlike(p), F.lit(k)) for k, p in SENSITIVE.items()]))


def page_number_only(text) -> Column:
    return c(text).rlike("^\\s*[-–—]?\\s*[0-9]+\\s*[-–—]?\\s*$")


# Words of titles that tell one statute from another no better than a number.
STOCK_TITLE = "the act ordinance code rules regulation order of and amendment consolidation validation licensing special courts".split()


def distinctive_title(title) -> Column:
    words = F.regexp_extract_all(F.lower(c(title)), F.lit("([a-z]{3,})"), F.lit(1))
    return F.exists(words, lambda w: ~w.isin(STOCK_TITLE) & ~w.rlike("^[ivxlc]+$"))


def instrument_kind(title) -> Column:
    """Code where the title begins with it, else the last kind word; null where there is none."""
    t = F.lower(c(title))
    found = F.regexp_extract_all(t, F.lit("\\b(act|ordinance|code|rules|regulation|order)\\b"), F.lit(1))
    return F.when(t.rlike("^(the )?code\\b"), F.lit("code")).otherwise(F.try_element_at(found, F.lit(-1)))


# Phrases around a party's name that tell nothing of it, in order, and words that tell nothing.
PARTY_NOISE = [
    "\\b(?:and|&)\\s+(?:\\d+|one|two|three|four|five|six|seven|eight|nine|ten|another|others?)\\b(?:\\s+others?)?", "\\betc\\b\\.?", "\\bthrough\\b.*$", "\\bthr\\b\\.?.*$",
    "\\(since\\s+dec(?:ease)?d\\)", "\\blrs\\b\\.?", "\\bm/s\\b\\.?", "\\bmessrs\\b\\.?", "\\bmst\\b\\.?", "\\bmr\\b\\.?", "\\bsyed\\b", "\\bch\\b\\.?", "^\\s*the\\s+", "\\b(?:pvt|private|ltd|limited)\\b\\.?",
]
PARTY_STOP = "and of the through thr v vs versus others another etc in for".split()


def party_key(name) -> Column:
    """A party for comparison: lower case, noise phrases and stopwords out, letters and single blanks only."""
    t = F.translate(F.lower(c(name)), "\ufffd", " ")
    for noise in PARTY_NOISE:
        t = F.regexp_replace(t, "(?U)" + noise, " ")
    words = F.split(F.regexp_replace(t, "[^a-z ]+", " "), " +")
    return F.array_join(F.filter(words, lambda w: (w != "") & ~w.isin(PARTY_STOP)), " ")


def act_short(title) -> Column:
    """The initials of a title's words (longer than two letters, not the article), upper case."""
    words = F.regexp_extract_all(F.upper(F.regexp_replace(c(title), "^(?i)the ", "")), F.lit("([A-Z]{3,})"), F.lit(1))
    return F.array_join(F.transform(F.filter(words, lambda w: ~w.isin("THE", "AND")), lambda w: w.substr(1, 1)), "")


CITATION = "\\b((?:19|20)[0-9]{2} [A-Z]{2,4} [0-9]+)\\b"


def citations(text) -> Column:
    """The printed citations 'YEAR SERIES NUMBER' of a text, in order, repeats kept."""
    return F.regexp_extract_all(c(text), F.lit(CITATION), F.lit(1))


MONTHS = "January February March April May June July August September October November December".split()


def to_iso(printed) -> Column:
    """An ISO date of the printed forms d.m.Y, d Month Y, Month d, Y and Y-m-d; null for anything else or no real date."""
    t = F.trim(c(printed))
    dmy = F.try_to_date(F.when(t.rlike("^[0-9]{1,2}\\.[0-9]{1,2}\\.[0-9]{4}$"), t), "d.M.y")
    iso = F.try_to_date(F.when(t.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), t), "yyyy-MM-dd")
    long = F.try_to_date(F.when(t.rlike("^[0-9]{1,2} [A-Z][a-z]+ [0-9]{4}$"), t), "d MMMM y")
    us = F.try_to_date(F.when(t.rlike("^[A-Z][a-z]+ [0-9]{1,2}, [0-9]{4}$"), t), "MMMM d, y")
    return F.date_format(F.coalesce(iso, dmy, long, us), "yyyy-MM-dd")


# Roles of a cited provision and the cues of its sentence, first match wins.
ROLES = [("charge", "contravenes|registered a report|liable to"), ("relief", "order|relief|claim invokes|application"), ("benchmark", "urged|attracted|reliance"), ("ratio", "held|provides|read with")]


def role_of(sentence) -> Column:
    low, out = F.lower(c(sentence)), None
    for name, cue in ROLES:
        out = F.when(low.rlike(cue), F.lit(name)) if out is None else out.when(low.rlike(cue), F.lit(name))
    return out.otherwise("mention")


DISPOSALS = [("dismissed", "dismissed|rejected"), ("allowed", "allowed|accepted"), ("remanded", "remanded|remitted"), ("disposed", "disposed of|discharged|ordered accordingly")]


def disposition(text) -> Column:
    """The strongest verb of the closing quarter (2,000 to 6,000 characters), by fixed order; null where there is none."""
    low, out = F.lower(closing_window(text, 0.25, 2000, 6000)), None
    for name, cue in DISPOSALS:
        out = F.when(low.rlike(cue), F.lit(name)) if out is None else out.when(low.rlike(cue), F.lit(name))
    return out


# What separates words; letters and marks of other scripts are none of it.
WHITE = "[\\s\\x0B\\x1C-\\x1F\\x85\\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]"
SOLID = WHITE.replace("[", "[^", 1)


def loops(text) -> Column:
    """Whether a text repeats itself: 4 equal words running, or the same three words in 4 places, case ignored."""
    low = F.lower(c(text))
    running = low.rlike(f"(?<!{SOLID})({SOLID}++)(?:{WHITE}++\\1(?!{SOLID})){{3}}")
    words = F.filter(F.split(low, f"{WHITE}+"), lambda w: w != "")
    # each array is bound to a lambda variable, else it is computed anew for every element
    grams = F.transform(F.array(words), lambda w: F.when(F.size(w) >= 6, F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.concat_ws(" ", w[i], w[i + 1], w[i + 2]))))
    # equal trigrams stand together once sorted: the fourth is three places behind the first
    often = F.exists(F.transform(grams, lambda g: F.sort_array(g)), lambda g: F.when(F.size(g) >= 4, F.exists(F.sequence(F.lit(0), F.size(g) - 4), lambda i: g[i] == g[i + 3])).otherwise(False))
    return F.coalesce(running | often, F.lit(False))


def quality(text) -> Column:
    """0.9; -0.5 where under half of the visible characters are letters or digits; -0.3 with replacement characters; -0.4 where
    the text loops; not below 0, and 0 for none."""
    solid = F.length(F.regexp_replace(c(text), WHITE, ""))
    letters = F.length(F.regexp_replace(c(text), "[^\\p{L}\\p{N}]", ""))
    q = F.lit(0.9) - F.when(letters < solid * 0.5, 0.5).otherwise(0.0) - F.when(c(text).contains("\ufffd"), 0.3).otherwise(0.0) - F.when(loops(text), 0.4).otherwise(0.0)
    return F.when(F.coalesce(solid, F.lit(0)) == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.round(q, 4)))


def overlap_area(a, b) -> Column:
    """The area two boxes [x0, y0, x1, y1] share."""
    w = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    return w * F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))


def area(a) -> Column:
    return F.greatest(F.lit(0.0), a[2] - a[0]) * F.greatest(F.lit(0.0), a[3] - a[1])


def wilson(p, n, z: float = 1.96):
    """(low, high) of the Wilson interval of share p over n."""
    centre, spread = (p + z * z / (2 * n)), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return (centre - spread) / (1 + z * z / n), (centre + spread) / (1 + z * z / n)
