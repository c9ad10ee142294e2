"""Rule vocabularies of relations, as data, and the Column expressions and SQL made from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tie class by relation.
TIE_CLASS = {
    "interaction": (
        "replied_to", "mentions", "quoted", "retweeted", "forwarded_from", "follows", "met_with", "visited", "recruited",
        "subordinate_to", "commanded", "appointed_by", "imprisoned_by", "family_of", "married_to", "friend_of", "sibling_of",
        "related_to", "knew", "mentored", "served_with", "succeeded",
    ),
    "affiliation": (
        "posted_in", "member_of", "joined", "served_in", "led", "founded", "employed_by", "studied_at", "expelled_from",
        "propagandized_for", "worked_for", "co_affiliated", "board_member_of", "director_of", "chairs", "affiliated_with",
        "owns", "owned_by", "controls", "subsidiary_of", "fiscal_sponsor_of", "project_of", "part_of", "reports_to", "managed",
        "operates_in", "funded", "donated_to", "granted", "provided_resources_to", "contracted", "coordinated_with",
    ),
    "participation": ("participated_in", "fought_in", "wounded_at", "attended_event", "responded_to"),
    "biographical": ("born_in", "resided_in", "located_in", "lived_in", "promoted_to", "died_in"),
    "stance": (
        "advised", "supported", "opposed", "influenced_by", "fought_against", "admired", "read", "believed_in", "allied_with",
        "sympathized_with", "lobbied", "lobbied_for",
    ),
    "causal": ("caused", "caused_by", "contributed_to", "prevented", "led_to", "resulted_in"),
    "cooccurrence": ("co_occurs_with", "co_present_in_scene"),
    "other": ("alias_of",),
}
CLASSES = ("interaction", "affiliation", "participation", "biographical", "stance", "causal", "cooccurrence", "other")
# Tie class by the target's label, for relations not listed.
LABEL_CLASS = {"ORG": "affiliation", "INSTITUTION": "affiliation", "EVENT": "participation", "LOCATION": "biographical", "RANK": "biographical"}
# Parts of words that mean opposition.
OPPOSITION = ("oppos", "against", "rival", "enem", "resist", "denounce", "boycott", "defied", "defy", "fought_against")
# Relations that are interactions between two persons.
PERSON_TO_PERSON = ("led", "commanded", "recruited", "mentored", "appointed_by", "subordinate_to", "succeeded")
# Relations without direction, and parts of words that mean it.
SYMMETRIC = (
    "met_with", "family_of", "married_to", "friend_of", "sibling_of", "related_to", "knew", "served_with",
    "allied_with", "co_occurs_with", "co_affiliated", "co_present_in_scene",
)
SYMMETRIC_PARTS = (
    "_with", "married", "spouse", "partner", "colleague", "friend", "sibling", "relative", "related_to", "associate",
    "allied", "co_founded", "cofounded", "co-founded", "negotiat", "acquainted",
)
# Signs of relations.
POSITIVE = ("supported", "admired", "allied_with", "sympathized_with", "friend_of", "mentored", "recruited")
NEGATIVE = ("opposed", "fought_against", "imprisoned_by", "expelled_from")
POSITIVE_PARTS = (
    "friend", "ally", "allied", "support", "admir", "recruit", "mentor", "trust", "loyal", "marri", "partner",
    "praise", "thank", "respect", "befriend", "sympath", "favor",
)
NEGATIVE_PARTS = (
    "oppos", "against", "dislik", "undermin", "clash", "disagree", "rival", "enem", "betray", "attack", "fought",
    "conflict", "denounce", "hostile", "threat", "distrust", "hate", "feud", "boycott", "persecut", "imprison",
    "expel", "arrest",
)
# Connection type by relation.
CONNECTION = {
    "physical": (
        "met_with", "visited", "family_of", "married_to", "sibling_of", "related_to", "employed_by", "worked_for",
        "served_with", "served_in", "fought_against", "fought_in", "wounded_at", "commanded", "recruited", "imprisoned_by",
        "appointed_by", "funded", "donated_to", "granted", "coordinated_with", "provided_resources_to", "contracted",
        "responded_to", "participated_in",
    ),
    "ideological": (
        "lobbied", "lobbied_for", "advised", "supported", "opposed", "influenced_by", "admired", "read", "believed_in",
        "allied_with", "sympathized_with", "propagandized_for",
    ),
    "organizational": (
        "member_of", "joined", "led", "founded", "studied_at", "expelled_from", "subordinate_to", "co_affiliated",
        "board_member_of", "director_of", "chairs", "affiliated_with", "owns", "owned_by", "controls", "subsidiary_of",
        "fiscal_sponsor_of", "project_of", "part_of", "reports_to", "managed", "operates_in",
    ),
    "biographical": ("promoted_to", "born_in", "resided_in", "located_in", "lived_in", "died_in"),
    "cooccurrence": ("co_occurs_with",),
    "none": ("alias_of",),
}
IDEOLOGICAL_PARTS = ("support", "oppos", "influenc", "admir", "ideolog", "propagand", "believ", "sympath", "endors", "inspir", "allied", "praise")
PHYSICAL_PARTS = (
    "met", "visit", "fund", "financ", "fought", "combat", "marri", "famil", "sibling", "employ", "arrest", "imprison",
    "wound", "recruit", "kill", "assassinat",
)
ORGANIZATIONAL_PARTS = ("member", "join", "founded", "studi", "expel", "subordinate")
# Labels that a relation's source and target may have; o: an organisation of either kind.
CORE_LABELS = ("PERSON", "ORG", "INSTITUTION", "LOCATION", "GPE", "RANK", "EVENT")
_KIND = {"person": ("PERSON",), "org": ("ORG", "INSTITUTION"), "place": ("LOCATION", "GPE"), "rank": ("RANK",), "event": ("EVENT",)}
SIGNATURES = {
    "employed_by": (("person",), ("org", "person")),
    "led": (("person",), ("org", "event")),
    "studied_at": (("person",), ("org", "place")),
    "founded": (("person", "org"), ("org",)),
    "founded_by": (("org",), ("person", "org")),
    "owns": (("person", "org"), ("org",)),
    "owned_by": (("org",), ("person", "org")),
    "born_in": (("person",), ("place",)),
    "lived_in": (("person",), ("place",)),
    "resided_in": (("person",), ("place",)),
    "died_in": (("person",), ("place",)),
    "located_in": (("person", "org", "place", "event"), ("place",)),
    "married_to": (("person",), ("person",)),
    "sibling_of": (("person",), ("person",)),
    "family_of": (("person",), ("person",)),
    "promoted_to": (("person",), ("rank",)),
    "board_member_of": (("person",), ("org",)),
    "director_of": (("person",), ("org",)),
    "subsidiary_of": (("org",), ("org",)),
    "fiscal_sponsor_of": (("org",), ("org",)),
    "project_of": (("org",), ("org",)),
}
# Relations with at most one target a subject.
FUNCTIONAL = ("born_in", "birth_date", "date_of_birth", "died_in", "place_of_death", "date_of_death")
# Sources of edges by evidence tier.
ASSERTED = ("llm_extracted", "langextract_extracted", "rule_extracted", "metadata", "social_graph", "littlesis")
INFERRED = ("canonical_inferred",)
# Affiliation-like relations that don't make their sources co-members.
NON_PROJECTING = (
    "funded", "donated_to", "granted", "provided_resources_to", "contracted", "owns", "owned_by", "controls",
    "subsidiary_of", "fiscal_sponsor_of", "coordinated_with",
)
# Relations that count as ideological in the quality of a connection.
IDEOLOGICAL_RELATIONS = (
    "supports", "support", "endorses", "endorsed", "opposes", "opposed", "allied_with", "sympathizes_with",
    "aligned_with", "promotes",
)
# Narrative elements by keywords, the first that matches counts.
LIFE_COURSE = {
    "war_combat": "war|front|battle|combat|soldier|regiment|trench|wounded|krieg|soldat|schlacht|schützengraben",
    "violence": "street fight|beaten|riot|clash|freikorps|putsch|murder|assault|gewalt|schlägerei",
    "politics_party": "party|nsdap|rally|election|movement|agitation|propaganda|partei|versammlung|bewegung|wahl",
    "education": "school|university|studied|gymnasium|examination|studium|schule|universität|lehrer",
    "work_economic": "factory|unemploy|wage|business|farm|trade|apprentice|arbeit|stelle|fabrik|arbeitslos",
    "family": "father|mother|married|wife|child|born|family|vater|mutter|heirat|geboren|familie",
    "migration": "emigrat|returned|travel|moved to|zog|auswander",
    "hardship_crisis": "hunger|poverty|inflation|crisis|illness|death|elend|armut|krise|krankheit|tod",
    "religion": "church|faith|catholic|protestant|kirche|glaube|katholisch|evangelisch",
}
FICTION = {
    "death": "death|died|killed|murder|slain|funeral|grave|corpse",
    "violence_conflict": "fight|battle|attack|duel|ambush|struggle|blood|wound|war",
    "romance": "love|kiss|embrace|wedding|married|affair|courtship|lover|betrothed",
    "betrayal": "betray|treachery|deceive|trick|double-cross|traitor|backstab",
    "revelation": "discover|reveal|realize|uncover|secret|confess|truth|prophecy",
    "journey": "journey|travel|set out|depart|arrive|voyage|quest|road|sail",
    "threat_danger": "danger|threat|trap|pursue|chase|escape|flee|hunt|captured",
    "crime": "steal|theft|robbery|kidnap|ransom|heist|burglary|smuggle",
    "power_politics": "throne|crown|king|queen|rule|power|election|conspiracy|coup|council",
    "celebration": "feast|party|celebration|festival|banquet|triumph|victory|toast",
    "loss_grief": "loss|grief|mourning|exile|ruin|despair|abandon|orphan",
    "reconciliation": "forgive|reunite|reconcile|peace|redemption|homecoming|restored",
}
# Publishers, archives and endings that only reference lists name.
PUBLISHERS = (
    "routledge", "springer", "elsevier", "wiley", "john wiley & sons", "sage", "sage publications", "palgrave",
    "palgrave macmillan", "macmillan", "pearson", "norton", "w w norton", "penguin", "penguin books",
    "harpercollins", "mcgraw-hill", "blackwell", "wiley-blackwell", "taylor & francis", "dk", "prentice hall",
    "academic press", "oup", "the wayback machine", "wayback machine", "internet archive", "jstor", "google books",
    "google scholar", "researchgate", "semantic scholar", "crossref", "pubmed", "arxiv", "worldcat", "doi", "isbn",
)
PUBLISHER_ENDINGS = ("press", "publishing", "publishers", "verlag", "books")
#: A person's name in the forms of reference lists.
BIBLIOGRAPHIC = r"^[^\s,]+,\s+[A-Z]|\s[A-Z]{2,3}$|\s[A-Z]\.$"


def _key(rel: Column) -> Column:
    return F.lower(F.trim(F.coalesce(rel, F.lit(""))))


def _any(column: Column, parts: tuple[str, ...]) -> Column:
    return column.rlike("|".join(parts))


def _listed(key: Column, groups: dict[str, tuple[str, ...]]) -> Column:
    """The group that lists the key, else null: a chain of set look-ups, no join."""
    chain = F.lit(None).cast("string")
    for name, members in reversed(groups.items()):
        chain = F.when(key.isin(*members), F.lit(name)).otherwise(chain)
    return chain


def _by_label(label: Column) -> Column:
    chain = F.lit(None).cast("string")
    for name, found in LABEL_CLASS.items():
        chain = F.when(label == name, F.lit(found)).otherwise(chain)
    return chain


def tie_class(rel: Column, source: Column, target: Column) -> Column:
    """Tie class of a relation between labels ('' where unknown)."""
    key, source, target = _key(rel), F.coalesce(source, F.lit("")), F.coalesce(target, F.lit(""))
    listed, fallback = _listed(key, TIE_CLASS), _by_label(target)
    persons = (source == "PERSON") & (target == "PERSON")
    return (
        F.when(target.isin("ORG", "INSTITUTION") & _any(key, OPPOSITION), "stance")
        .when((listed == "interaction") & (source != "") & (target != "") & ~persons, F.coalesce(fallback, F.lit("affiliation")))
        .when(listed.isNotNull() & persons & key.isin(*PERSON_TO_PERSON), "interaction")
        .when(listed.isNotNull(), listed)
        .when(fallback.isNotNull(), fallback)
        .when(persons, "interaction")
        .otherwise("other")
    )


def is_symmetric(rel: Column) -> Column:
    return _key(rel).isin(*SYMMETRIC) | _any(_key(rel), SYMMETRIC_PARTS)


def polarity(rel: Column) -> Column:
    key = _key(rel)
    return (
        F.when(key.isin(*POSITIVE), "positive")
        .when(key.isin(*NEGATIVE) | _any(key, NEGATIVE_PARTS), "negative")
        .when(_any(key, POSITIVE_PARTS), "positive")
        .otherwise("neutral")
    )


def connection_type(rel: Column, target: Column) -> Column:
    key, target = _key(rel), F.coalesce(target, F.lit(""))
    return (
        F.when(_listed(key, CONNECTION).isNotNull(), _listed(key, CONNECTION))
        .when(_any(key, IDEOLOGICAL_PARTS), "ideological")
        .when(_any(key, PHYSICAL_PARTS), "physical")
        .when(_any(key, ORGANIZATIONAL_PARTS), "organizational")
        .when(target.isin("LOCATION", "RANK"), "biographical")
        .when(target.isin("ORG", "INSTITUTION"), "organizational")
        .otherwise("unspecified")
    )


def allowed_labels(side: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(label for word in side for label in _KIND[word])


def type_violation(rel: Column, source: Column, target: Column) -> Column:
    """A label that the relation's signature rules out; labels that aren't modelled pass."""
    found = F.lit(False)
    for name, sides in SIGNATURES.items():
        left, right = (allowed_labels(s) for s in sides)
        wrong = lambda label, good: label.isin(*[x for x in CORE_LABELS if x not in good])
        found = F.when(rel == name, wrong(source, left) | wrong(target, right)).otherwise(found)
    return F.coalesce(found, F.lit(False))


def tier_allows(sources: Column, tier: str) -> Column:
    """An edge belongs to a tier if any of its ;-joined sources does; full admits all."""
    allowed = {"conservative": ASSERTED, "moderate": ASSERTED + INFERRED}.get(tier)
    if allowed is None:
        return F.lit(True)
    return F.arrays_overlap(F.split(F.coalesce(sources, F.lit("")), ";"), F.array(*[F.lit(a) for a in allowed]))


def excludes_all(sources: Column, excluded: list[str]) -> Column:
    """Every source of the edge is an excluded one."""
    named = F.filter(F.split(F.coalesce(sources, F.lit("")), ";"), lambda s: s != "")
    return (F.size(named) > 0) & (F.size(F.array_except(named, F.array(*[F.lit(e) for e in excluded]))) == 0)


def narrative_element(text: Column, scheme: dict[str, str] = LIFE_COURSE) -> Column:
    chain = F.lit("other")
    for name, words in reversed(scheme.items()):
        chain = F.when(F.lower(F.coalesce(text, F.lit(""))).rlike(words), F.lit(name)).otherwise(chain)
    return chain


def citation_artifact(name: Column, label: Column, key: Column) -> Column:
    org = key.isin(*PUBLISHERS) | key.rlike("(^|.* )(" + "|".join(PUBLISHER_ENDINGS) + ")$")
    return F.when(label.isin("ORG", "INSTITUTION"), org).when(label == "PERSON", F.trim(name).rlike(BIBLIOGRAPHIC)).otherwise(F.lit(False))


def connection_quality(origin: Column, rel: Column, evidence: Column) -> Column:
    """structural, ideological or direct."""
    ideological = F.lower(rel).isin(*IDEOLOGICAL_RELATIONS)
    return (
        F.when(origin.isin("inferred", "canonical"), "structural")
        .when(ideological, "ideological")
        .when(F.coalesce(evidence, F.lit("")) != "", "direct")
        .otherwise("structural")
    )
