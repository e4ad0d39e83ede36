"""Biographical fields from the first sentence of an article."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dates import MONTH, earliest, latest, normalise
from .text import ANY_CASE, FLAGS, any_of, group, has, let, present, strip, sub

# Nationalities.
NATIONALITIES = (
    "afghan", "albanian", "algerian", "american", "andorran", "angolan", "argentine", "argentinian", "armenian",
    "australian", "austrian", "azerbaijani", "bahamian", "bahraini", "bangladeshi", "barbadian", "belarusian",
    "belgian", "belizean", "beninese", "bhutanese", "bolivian", "bosnian", "botswanan", "brazilian", "british",
    "bruneian", "bulgarian", "burkinabe", "burmese", "burundian", "cambodian", "cameroonian", "canadian",
    "cape verdean", "central african", "chadian", "chilean", "chinese", "colombian", "comorian", "congolese",
    "costa rican", "croatian", "cuban", "cypriot", "czech", "danish", "djiboutian", "dominican", "dutch",
    "east timorese", "ecuadorian", "egyptian", "emirati", "english", "equatorial guinean", "eritrean", "estonian",
    "ethiopian", "fijian", "filipino", "finnish", "flemish", "french", "gabonese", "gambian", "georgian", "german",
    "ghanaian", "greek", "grenadian", "guatemalan", "guinean", "guyanese", "haitian", "honduran", "hungarian",
    "icelandic", "indian", "indonesian", "iranian", "iraqi", "irish", "israeli", "italian", "ivorian", "jamaican",
    "japanese", "jordanian", "kazakh", "kenyan", "korean", "kosovar", "kuwaiti", "kyrgyz", "laotian", "latvian",
    "lebanese", "liberian", "libyan", "liechtensteiner", "lithuanian", "luxembourgish", "macedonian", "malagasy",
    "malawian", "malaysian", "maldivian", "malian", "maltese", "mauritanian", "mauritian", "mexican", "moldovan",
    "monacan", "mongolian", "montenegrin", "moroccan", "mozambican", "namibian", "nepalese", "new zealand",
    "nicaraguan", "nigerian", "nigerien", "north korean", "norwegian", "omani", "ottoman", "pakistani", "palauan",
    "palestinian", "panamanian", "papua new guinean", "paraguayan", "persian", "peruvian", "polish", "portuguese",
    "prussian", "puerto rican", "qatari", "romanian", "roman", "russian", "rwandan", "salvadoran", "samoan", "saudi",
    "scottish", "senegalese", "serbian", "sierra leonean", "singaporean", "slovak", "slovenian", "somali",
    "south african", "south korean", "soviet", "spanish", "sri lankan", "sudanese", "surinamese", "swazi", "swedish",
    "swiss", "syrian", "taiwanese", "tajik", "tanzanian", "thai", "togolese", "tongan", "trinidadian", "tunisian",
    "turkish", "turkmen", "ugandan", "ukrainian", "uruguayan", "uzbek", "venezuelan", "vietnamese", "welsh", "yemeni",
    "zambian", "zimbabwean", "byzantine", "austro-hungarian", "czechoslovak", "yugoslav",
)
# Occupations.
OCCUPATIONS = (
    "activist", "actor", "actress", "admiral", "alpinist", "ambassador", "anthropologist", "archaeologist",
    "architect", "artist", "astronaut", "astronomer", "athlete", "author", "aviator", "banker", "biologist", "bishop",
    "botanist", "boxer", "broadcaster", "businessman", "businesswoman", "cardinal", "cartographer", "cellist",
    "chancellor", "chef", "chemist", "choreographer", "cinematographer", "clergyman", "coach", "collector",
    "comedian", "commander", "commentator", "composer", "conductor", "congressman", "consultant", "courtier",
    "critic", "cryptographer", "curator", "cyclist", "dancer", "designer", "diplomat", "director", "dramatist",
    "economist", "editor", "educator", "emperor", "empress", "engineer", "engraver", "entertainer", "entrepreneur",
    "essayist", "ethnographer", "evangelist", "explorer", "feminist", "fencer", "filmmaker", "financier", "general",
    "geneticist", "geographer", "geologist", "golfer", "governor", "guitarist", "historian", "illustrator", "imam",
    "inventor", "journalist", "judge", "jurist", "king", "lawyer", "lexicographer", "librettist", "linguist",
    "lyricist", "magistrate", "mathematician", "mayor", "medic", "memoirist", "merchant", "meteorologist",
    "microbiologist", "military officer", "minister", "missionary", "monarch", "monk", "mountaineer", "musician",
    "musicologist", "mystic", "naturalist", "navigator", "neuroscientist", "nobleman", "novelist", "nun", "nurse",
    "officer", "organist", "painter", "paleontologist", "pastor", "patron", "pedagogue", "philanthropist",
    "philosopher", "photographer", "physician", "physicist", "pianist", "pilot", "playwright", "poet",
    "political scientist", "politician", "polymath", "pope", "preacher", "president", "priest", "prince", "princess",
    "printmaker", "producer", "professor", "programmer", "psychiatrist", "psychologist", "publisher", "queen",
    "rabbi", "racer", "reformer", "regent", "researcher", "revolutionary", "ruler", "sailor", "saint", "scholar",
    "scientist", "screenwriter", "sculptor", "senator", "singer", "singer-songwriter", "sociologist", "soldier",
    "songwriter", "spy", "statesman", "stateswoman", "sultan", "surgeon", "swimmer", "teacher", "theologian",
    "trader", "translator", "violinist", "vocalist", "warrior", "writer", "zoologist",
)
# Date and clause forms.
_FULL = rf"(?:(?:\d{{1,2}}\s+{MONTH}\s+\d{{3,4}})|(?:{MONTH}\s+\d{{1,2}},?\s+\d{{3,4}}))"
DATE = rf"(?:c\.\s*)?(?:{_FULL}|\d{{3,4}})"
_DASH = r"[–—\-]"
_TAIL = r"(?:\s*;[^)]*?)?\)"
LIFE = rf"\(({DATE})\s*{_DASH}\s*({DATE}){_TAIL}"
BORN_LIFE = rf"\(\s*born\s+({DATE})\s*{_DASH}\s*({DATE}){_TAIL}"
BORN = rf"\(\s*born\s+({DATE})\s*\)"
CLAUSE = (
    r"(?:was|is)\s+(?:a|an|the)\s+(.*?)(?:\s+(?:who|that|whose|best|widely|known)\b|\.\s"
    r"|,\s+(?:who\b|whose\b|born\b|and\s+(?:the\b|a\b|founder\b|one\b|co-))|$)"
)
DESCENT = r"\bof\s+(\w+)\s+(?:origin|descent|birth|heritage|extraction|ancestry)\b"


_PHRASES = sorted((n for n in NATIONALITIES if " " in n), key=len, reverse=True)
_ANY_PHRASE = rf"\b{any_of(_PHRASES)}\b"
# Words of origin beside a nationality.
_ORIGINS = ("born", "naturalised", "naturalized")

#: What a text tells.
FIELDS = ("birth_date", "death_date", "nationality", "occupation")


def first_paragraph(text: Column) -> Column:
    return F.substring_index(F.substring(text, 1, 500), "\n\n", 1)


def _dates_in(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(ANY_CASE + DATE), F.lit(0))
    return F.filter(F.transform(found, normalise), lambda d: d.isNotNull())


def life_dates(text: Column) -> Column:
    """A struct of ``birth`` and ``death`` from the first parenthesis that tells them."""

    pair = lambda both: F.struct(F.get(both, F.lit(0)).alias("birth"), F.get(both, F.lit(1)).alias("death"))

    def loose(inside: Column) -> Column:
        halves = F.transform(F.split(inside, FLAGS + rf"\s+{_DASH}\s+", 2), _dates_in)
        return let(halves, lambda h: pair(F.array(earliest(F.get(h, F.lit(0))), latest(F.get(h, F.lit(1))))))

    at = lambda pattern, *n: F.array(*[group(text, pattern, i, ANY_CASE) for i in n])
    stated = F.when(has(text, LIFE, ANY_CASE), at(LIFE, 1, 2)).when(has(text, BORN_LIFE, ANY_CASE), at(BORN_LIFE, 1, 2)).when(has(text, BORN, ANY_CASE), at(BORN, 1))
    return let(stated, lambda s: F.when(s.isNotNull(), let(F.transform(s, normalise), pair)).otherwise(let(group(text, r"\(([^)]+)\)"), loose)))


def _phrases(clause: Column) -> Column:
    """Nationalities of several words in the clause, as it writes them."""
    return F.regexp_extract_all(clause, F.lit(ANY_CASE + _ANY_PHRASE), F.lit(0))


def _tokens(clause: Column, phrases: Column) -> Column:
    """Lower-case words of the clause without its ``_phrases``."""
    rest = F.when(F.size(phrases) > 0, sub(clause, _ANY_PHRASE, "", ANY_CASE)).otherwise(clause)
    return F.transform(F.split(strip(rest), FLAGS + r"\s+"), lambda w: F.rtrim(F.lower(w), F.lit(".,;")))


def nationality(phrases: Column, tokens: Column) -> Column:
    """Nationalities of a clause's ``_phrases``, then of its tokens up to the first occupation, joined by commas."""
    none, every = F.array().cast("array<string>"), F.array(*map(F.lit, _PHRASES))
    long = F.when(F.size(phrases) > 0, let(F.transform(phrases, F.lower), lambda held: F.filter(every, lambda p: F.array_contains(held, p)))).otherwise(none)

    def of_token(t: Column) -> Column:
        whole = F.when(t.isin(*NATIONALITIES), F.array(t)).otherwise(none)
        part = F.filter(F.split(t, "-"), lambda p: p.isin(*NATIONALITIES))
        return F.when(t.contains("-"), F.concat(F.slice(part, 1, 1), whole)).otherwise(whole)

    trades = F.transform(tokens, lambda t: t.isin(*OCCUPATIONS) | F.rtrim(t, F.lit("s")).isin(*OCCUPATIONS))
    zone = let(F.array_position(trades, True), lambda stop: F.when(stop > 0, F.slice(tokens, F.lit(1), stop.cast("int"))).otherwise(tokens))
    single = F.flatten(F.transform(zone, of_token))
    return present(F.array_join(F.array_distinct(F.transform(F.concat(long, single), F.initcap)), ", "))


def occupation(tokens: Column) -> Column:
    """Occupations of a clause's tokens, each with the word before it where that is not one, joined by commas."""

    def run() -> Column:
        start = F.struct(F.lit(False).alias("skip"), F.array().cast("array<string>").alias("found"))

        def step(state: Column, i: Column) -> Column:
            now, after = F.get(tokens, i), F.get(tokens, i + 1)
            parts = F.split(now, "-")
            origin = F.exists(parts, lambda p: p.isin(*NATIONALITIES) | p.isin(*_ORIGINS)) & F.forall(parts, lambda p: p.isin(*NATIONALITIES) | p.isin(*_ORIGINS, "and"))
            idle = state["skip"] | now.isin("", "and", "or") | origin
            pair = F.coalesce(after.isin(*OCCUPATIONS), F.lit(False)) & ~now.isin(*NATIONALITIES)
            trade = F.when(idle, F.lit(None).cast("string")).when(now.isin(*OCCUPATIONS), now).when(pair, F.concat_ws(" ", now, after))
            added = lambda t: F.struct(F.coalesce(t != now, F.lit(False)).alias("skip"), F.when(t.isNull(), state["found"]).otherwise(F.concat(state["found"], F.array(t))).alias("found"))
            return let(trade, added)

        return F.aggregate(F.sequence(F.lit(0), F.size(tokens) - 1), start, step, lambda s: s["found"])

    return present(F.array_join(run(), ", "))


def told(rows: DataFrame, text: Column, wanted: tuple[str, ...] | list[str] = FIELDS, prefix: str = "") -> DataFrame:
    """``rows`` with a column, named by ``prefix`` and field, for each of the wanted ``FIELDS`` that an article's plain text tells.

    Each step is a column that later ones read, and what no wanted field needs is not computed.
    """
    made = {}
    rows = rows.withColumn("_lead", first_paragraph(text))
    lead = F.col("_lead")
    if {"birth_date", "death_date"} & set(wanted):
        rows = rows.withColumn("_life", life_dates(lead))
        made |= {"birth_date": F.col("_life.birth"), "death_date": F.col("_life.death")}
    if {"nationality", "occupation"} & set(wanted):
        rows = rows.withColumn("_clause", group(lead, CLAUSE, 1, ANY_CASE)).withColumn("_phrases", _phrases(F.col("_clause"))).withColumn("_tokens", _tokens(F.col("_clause"), F.col("_phrases")))
        told_by_clause = F.col("_clause") != ""
        by_descent = let(F.lower(group(lead, DESCENT, 1, ANY_CASE)), lambda d: F.when(d.isin(*NATIONALITIES), F.initcap(d)))
        made["occupation"] = F.when(told_by_clause, occupation(F.col("_tokens")))
        made["nationality"] = F.coalesce(F.when(told_by_clause, nationality(F.col("_phrases"), F.col("_tokens"))), by_descent)
    return rows.withColumns({f"{prefix}{f}": made[f] for f in wanted}).drop("_lead", "_life", "_clause", "_phrases", "_tokens")
