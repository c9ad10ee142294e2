"""What speaks for a person's membership in an organisation, by strength."""

from __future__ import annotations

from dataclasses import dataclass

# The confidence of a membership by tier of evidence; tier 0 is assumed of a corpus' authors.
CONFIDENCE = {0: 0.95, 1: 0.85, 2: 0.78, 3: 0.68, 4: 0.50}


@dataclass(frozen=True)
class Evidence:
    """Tiers 1 to 4: ranks of the organisation, patterns, its names as whole words, words of its surroundings."""

    name: str
    ranks: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()
    names: tuple[str, ...] = ()
    context: tuple[str, ...] = ()
    assumed: bool = False

    def signals(self) -> list[tuple[int, str, str]]:
        """(tier, kind, signal) in the order in which they are tried; kind: text, pattern or word."""
        tiers = ((1, "text", self.ranks), (2, "pattern", self.patterns), (3, "word", self.names), (4, "text", self.context))
        return [(tier, kind, s) for tier, kind, signals in tiers for s in signals]


# Organisations of the interwar pack.
INTERWAR = (
    Evidence(
        "NSDAP",
        ranks=("ortsgruppenleiter", "kreisleiter", "gauleiter", "reichsleiter", "blockleiter", "zellenleiter"),
        patterns=(r"\bNSDAP[-\s]?(?:Nr\.?|Nummer|No\.?)\s*\d{2,7}", r"\b(?:joined|trat .* bei|eintritt in die) .*\b(?:NSDAP|Partei|Bewegung)\b", r"\bParteigenosse\b", r"\bPg\.\s", r"\bMitglied der (?:NSDAP|Partei|Bewegung)\b"),
        names=("nsdap", "national socialist", "nationalsozialist", "nazi party", "die partei", "the party", "movement", "bewegung", "hitler party", "hitlerpartei"),
        context=("party member", "parteimitglied", "old fighter", "alter kämpfer", "alter kaempfer"),
        assumed=True,
    ),
    Evidence(
        "SA (Sturmabteilung)",
        ranks=("sa-sturmführer", "sa-sturmfuehrer", "sa-truppführer", "sa-scharführer", "sa-standartenführer", "sturmführer", "rottenführer", "sa-mann"),
        patterns=(r"\bSA[-\s]?(?:Sturm|Sturmbann|Standarte|Brigade|Gruppe)\b", r"\bin die SA\b", r"\bjoined the SA\b", r"\bSA-Mann\b", r"\bDienst in der SA\b"),
        names=("sa", "sturmabteilung", "storm trooper", "stormtrooper", "brownshirt", "brown shirt", "braunhemd", "sturmtrupp"),
        context=("marched with the sa", "sa duty", "sa-dienst", "saal protection", "saalschutz", "ordnertruppe"),
    ),
    Evidence(
        "SS (Schutzstaffel)",
        ranks=("ss-sturmführer", "ss-sturmfuehrer", "ss-untersturmführer", "ss-obersturmführer", "ss-hauptsturmführer", "ss-standartenführer", "reichsführer-ss", "ss-mann"),
        patterns=(r"\bSS[-\s]?(?:Nr\.?|Nummer)\s*\d{1,7}", r"\bSS[-\s]?(?:Sturm|Sturmbann|Standarte|Abschnitt)\b", r"\bin die SS\b", r"\bjoined the SS\b", r"\bSS-Mann\b"),
        names=("ss", "schutzstaffel", "blackshirt", "black shirt", "allgemeine ss", "waffen-ss"),
        context=("ss duty", "ss-dienst", "elite guard", "leibstandarte"),
    ),
    Evidence(
        "Freikorps",
        patterns=(r"\bFreikorps\b", r"\bin ein Freikorps\b", r"\bFreikorps[-\s]?\w+\b"),
        names=("freikorps", "free corps", "freecorps"),
        context=("baltic campaign", "baltikum", "border fighting", "grenzschutz", "ruhr fighting", "kapp"),
    ),
    Evidence("Stahlhelm", patterns=(r"\bStahlhelm\b", r"\bBund der Frontsoldaten\b"), names=("stahlhelm", "steel helmet", "frontsoldaten"), context=("veterans league", "frontsoldat", "front soldier")),
    Evidence(
        "Hitler Youth (Hitlerjugend)",
        ranks=("hj-führer", "hj-fuehrer", "bannführer", "gefolgschaftsführer"),
        patterns=(r"\bHitlerjugend\b", r"\bHitler[-\s]?Jugend\b", r"\bin die HJ\b"),
        names=("hitler youth", "hitlerjugend", "hitler-jugend", "hj"),
        context=("jungvolk", "youth group", "jugendgruppe"),
    ),
    Evidence("NSKK", ranks=("nskk-sturmführer", "nskk-staffelführer"), patterns=(r"\bNSKK\b", r"\bKraftfahrkorps\b"), names=("nskk", "kraftfahrkorps", "motor corps"), context=("motor unit", "motorstaffel", "driver corps")),
    Evidence(
        "Reichswehr",
        patterns=(r"\bReichswehr\b", r"\bin die Reichswehr\b"),
        names=("reichswehr", "100,000 man army", "hunderttausend-mann-heer"),
        context=("regular army", "berufssoldat", "professional soldier", "schwarze reichswehr", "black reichswehr"),
    ),
)
