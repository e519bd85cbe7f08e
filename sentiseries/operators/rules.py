"""Word lists and constants of the sentiment rules."""

from __future__ import annotations

from dataclasses import dataclass, field

# Constants and word lists of the published lexicon-and-rule method
# (Hutto and Gilbert, ICWSM 2014, and its public implementations).
BOOST = 0.293
CAPS_BOOST = 0.733
NEGATION_FACTOR = -0.74
DISTANCE_DAMPING = (1.0, 0.95, 0.9)
EXCLAMATION_STEP, EXCLAMATION_MAX = 0.292, 4
QUESTION_STEP, QUESTION_STEPS, QUESTION_MAX = 0.18, 3, 0.96
NORMALIZER = 15.0

INTENSIFIERS = """
absolutely amazingly awfully completely considerably decidedly deeply effing
enormously entirely especially exceptionally extremely fabulously flipping flippin
fricking frickin frigging friggin fully fucking greatly hella highly hugely
incredibly intensely majorly more most particularly purely quite really remarkably
so substantially thoroughly totally tremendously uber unbelievably unusually
utterly very
""".split()

DAMPENERS = """
almost barely hardly kinda kindof kind-of less little marginally occasionally
partly scarcely slightly somewhat sorta sortof sort-of
""".split()
DAMPENER_PAIRS = ("just enough", "kind of", "sort of")

NEGATIONS = """
aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't couldn't
daren't didn't doesn't dont hadnt hasnt havent isnt mightnt mustnt neither don't
hadn't hasn't haven't isn't mightn't mustn't neednt needn't never none nope nor not
nothing nowhere oughtnt shant shouldnt uhuh wasnt werent oughtn't shan't shouldn't
uh-uh wasn't weren't without wont wouldnt won't wouldn't rarely seldom despite
""".split()

IDIOMS = {
    "the shit": 3.0,
    "the bomb": 3.0,
    "bad ass": 1.5,
    "yeah right": -2.0,
    "cut the mustard": 2.0,
    "kiss of death": -1.5,
    "hand to mouth": -2.0,
}

# Punctuation runs stripped from one end of a word.
STRIPPED_RUNS = (
    ".", "!", "?", ",", ";", ":", "-", "'", '"',
    "!!", "!!!", "??", "???", "?!?", "!?!", "?!?!", "!?!?",
)
# Unicode whitespace, as a character-class body.
SPACE = r"\s\x1c-\x1f\x85\p{Z}"


@dataclass(frozen=True)
class Rules:
    """The adjustable part of the rules: word lists and the contrast word."""

    boosters: dict[str, float] = field(
        default_factory=lambda: dict.fromkeys(INTENSIFIERS, BOOST) | dict.fromkeys(DAMPENERS, -BOOST)
    )
    negations: tuple[str, ...] = tuple(NEGATIONS)
    idioms: dict[str, float] = field(default_factory=lambda: dict(IDIOMS))
    contrast: str = "but"
