"""What each extraction mode reads. All names and aliases are fixed values."""

from __future__ import annotations

from .infobox import Infobox

BIO = Infobox(
    names=(
        "infobox person", "infobox artist", "infobox painter", "infobox musical artist", "infobox writer",
        "infobox scientist", "infobox politician", "infobox philosopher", "infobox military person",
        "infobox sportsperson", "infobox actor", "infobox architect", "infobox composer", "infobox royalty",
        "infobox monarch", "infobox noble", "infobox pharaoh",
    ),
    aliases={
        "birth_date": ("birth_date", "born", "birthdate"),
        "death_date": ("death_date", "died", "deathdate"),
        "nationality": ("nationality", "citizenship", "country"),
        "occupation": ("occupation", "known_for", "notable_works"),
        "birth_place": ("birth_place", "birthplace", "born"),
        "death_place": ("death_place", "deathplace"),
    },
    dates=frozenset({"birth_date", "death_date"}),
)
GEO = Infobox(
    names=(
        "infobox settlement", "infobox city", "infobox municipality", "infobox county", "infobox district",
        "infobox place",
    ),
    aliases={
        "population": ("population_total", "pop", "population"),
        "area_km2": ("area_km2", "area_total_km2", "area"),
        "elevation_m": ("elevation_m", "elevation"),
        "subdivision_name": ("subdivision_name1", "state", "region", "province"),
        "subdivision_type": ("subdivision_type1",),
    },
    numbers=frozenset({"population", "area_km2", "elevation_m"}),
)
BATTLE = Infobox(
    names=("infobox military conflict", "infobox civilian attack", "infobox war faction"),
    aliases={
        "date": ("date",),
        "location": ("place", "location"),
        "belligerents": ("combatant1", "combatant2", "combatants"),
        "result": ("result", "outcome"),
        "casualties": ("casualties1", "casualties2", "casualties"),
        "commanders": ("commander1", "commander2"),
    },
    dates=frozenset({"date"}),
)
EXPLORATION = Infobox(
    names=(
        "infobox spaceflight", "infobox spacecraft class", "infobox space station", "infobox spaceflight/dock",
        "infobox expedition", "infobox mission",
    ),
    aliases={
        "date": ("launch_date", "date", "start_date"),
        "destination": ("destination", "target"),
        "origin": ("launch_site", "origin"),
        "crew": ("crew_members", "crew_size", "crew", "operator"),
        "mission_type": ("mission_type", "type"),
        "status": ("status", "disposition", "outcome"),
    },
    dates=frozenset({"date"}),
)
ASTRONOMY = Infobox(
    names=(
        "infobox planet", "infobox star", "infobox galaxy", "infobox nebula", "infobox constellation", "infobox comet",
        "infobox asteroid", "infobox minor planet", "infobox pulsar",
    ),
    aliases={
        "type": ("type", "spectral", "mp_category"),
        "distance": ("dist_ly", "dist_pc", "distance", "aphelion"),
        "mass": ("mass", "launch_mass"),
        "radius": ("radius", "mean_radius"),
        "constellation": ("constellation", "const"),
        "discovery_date": ("discovered", "discovery_date", "discovery"),
        "orbital_period": ("period", "orbit_period", "orbital_period", "p_orbit"),
        "rotational_period": ("rotation", "rotational_period", "sidereal_day"),
    },
    dates=frozenset({"discovery_date"}),
)
BIOLOGY = Infobox(
    names=("speciesbox", "taxobox", "infobox disease", "infobox organism"),
    aliases={
        "type": ("regnum", "phylum", "classis", "ordo"),
        "scientific_name": ("binomial", "taxon", "binomial_authority"),
        "conservation_status": ("status",),
        "habitat": ("habitat",),
        "distribution": ("range", "range_description", "range_map_caption"),
    },
)
MATH = Infobox(
    names=(
        "infobox mathematical statement", "infobox mathematics", "infobox theorem", "infobox conjecture",
        "infobox equation",
    ),
    aliases={
        "field": ("field", "branch", "area"),
        "year_discovered": ("year", "conjectured", "proved", "date"),
        "discoverer": ("conjectured by", "proved by", "discoverer", "author"),
        "related_to": ("generalizations", "consequences", "related"),
    },
    dates=frozenset({"year_discovered"}),
)

MODES: dict[str, Infobox] = {"bio": BIO, "geo": GEO, "battle": BATTLE, "exploration": EXPLORATION, "astronomy": ASTRONOMY, "biology": BIOLOGY, "math": MATH}
#: Fields of a record unless others are asked for.
FIELDS: dict[str, tuple[str, ...]] = {m: tuple(s.aliases) for m, s in MODES.items()} | {"bio": ("birth_date", "death_date", "nationality", "occupation"), "etymology": ("etymology",)}
#: Fields that are dates and get a note.
DATE_FIELDS = ("birth_date", "death_date", "date", "discovery_date", "year_discovered")

_SPECIAL = {"battles_wars_conflicts": "battle", "explorations_voyages_spacecraft": "exploration", "astronomy": "astronomy", "biology": "biology", "mathematics_statistics": "math"}
_PEOPLE = "athletes businesspeople explorers historians movie_directors_actors musicians_composers philosophers photographers politicians_rulers religious_figures scientists visual_artists writers_authors"
_PLACES = "admin_subdivisions populated_places transportation buildings_structures historical_cultural demographics_economy rivers lakes peaks landforms landmarks coastlines mountain_ranges protected_areas"
STEM_MODES: dict[str, str] = _SPECIAL | dict.fromkeys(_PEOPLE.split(), "bio") | dict.fromkeys(_PLACES.split(), "geo")


def mode_of(stem: str, asked: str = "auto") -> str:
    """The mode of a pattern group; etymology, when asked for, holds for every group."""
    if asked == "etymology":
        return asked
    return STEM_MODES.get(stem, "bio" if asked == "auto" else asked)
