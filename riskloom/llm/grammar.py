"""A weighted finite-state grammar over word classes, composed of small transducers.

Words of a clause are mapped to classes. Each transducer reads the classes
of a clause and puts out, for each word, a factor (for the word's own
weight) and an amount that it adds. ``compose`` builds the product machine
over the states that can be reached: factors multiply, amounts add and are
scaled by the other machines' factors. One pass over a clause with the
composed machine gives the clause's score.

Classes: insult, threat verb, target (a person spoken to or about),
negation, report (someone else is said to have said it), other.
"""

from __future__ import annotations

from dataclasses import dataclass

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = CLASSES = ("insult", "threat", "target", "negation", "report", "other")

# Closed-class words of the grammar.
WORDS = {
    TARGET: "you your yours yourself he she him her they them their u du dich dir dein deine ihr euch sie er tu te toi "
            "ton ta vous votre vos il elle ils elles tú ti usted ustedes vosotros tus ellos ellas".split(),
    NEGATION: "not never no n't nor neither without nicht kein keine nie niemals pas jamais aucun aucune nunca jamás "
              "ningún ninguna tampoco".split(),
    REPORT: "said says say claimed claims wrote quoted quote called reported alleged sagte sagt schrieb behauptet "
            "meinte dit disait écrit affirmé cité dijo dice escribió afirmó".split(),
    THREAT: "kill hurt destroy murder beat shoot stab strangle töten umbringen verletzen schlagen erschießen tuer "
            "frapper détruire blesser matar golpear destruir herir".split(),
    INSULT: "idiot moron stupid loser scum trash worthless pathetic disgusting clown imbecile dumb fool bastard "
            "dummkopf trottel arschloch abschaum imbécile crétin connard ordure idiota estúpido imbécil basura".split(),
}


@dataclass(frozen=True)
class Transducer:
    """Moves: (state, class) -> (state, factor, amount); a missing move stays with factor 1, amount 0."""

    start: int
    moves: dict[tuple[int, str], tuple[int, float, float]]

    def step(self, state: int, kind: str) -> tuple[int, float, float]:
        return self.moves.get((state, kind), (state, 1.0, 0.0))


def insult() -> Transducer:
    """An insult counts with its own weight; a second one in the clause a little more."""
    return Transducer(0, {(0, INSULT): (1, 1.0, 0.0), (1, INSULT): (1, 1.2, 0.0),
                          **{(s, k): (s, 0.0, 0.0) for s in (0, 1) for k in (TARGET, NEGATION, REPORT, OTHER)}})


def threat(amount: float) -> Transducer:
    """A threat verb and a target, in either order, add ``amount``; a verb alone adds nothing."""
    return Transducer(0, {(0, THREAT): (1, 1.0, 0.0), (1, TARGET): (0, 1.0, amount),
                          (0, TARGET): (2, 1.0, 0.0), (2, THREAT): (0, 1.0, amount)})


def target() -> Transducer:
    """Insults in a clause that names a target count more."""
    return Transducer(0, {(0, TARGET): (1, 1.0, 0.0), (1, INSULT): (1, 1.3, 0.0)})


def negation(reach: int = 3) -> Transducer:
    """Insults and threats up to ``reach`` words after a negation count less."""
    moves: dict[tuple[int, str], tuple[int, float, float]] = {}
    for s in range(reach + 1):
        for k in CLASSES:
            moves[s, k] = (max(0, s - 1), 0.5 if s and k in (INSULT, THREAT, TARGET) else 1.0, 0.0)
        moves[s, NEGATION] = (reach, 1.0, 0.0)
    return Transducer(0, moves)


def reported() -> Transducer:
    """What follows a verb of report in the clause counts less."""
    return Transducer(0, {(0, REPORT): (1, 1.0, 0.0), (1, INSULT): (1, 0.7, 0.0), (1, THREAT): (1, 0.7, 0.0),
                          (1, TARGET): (1, 0.7, 0.0)})


def compose(parts: list[Transducer]) -> tuple[int, list[dict[str, tuple[int, float, float]]]]:
    """(start, table): the product machine; table[state][class] = (state, factor, amount)."""
    start = tuple(p.start for p in parts)
    number, table, todo = {start: 0}, [], [start]
    while todo:
        state = todo.pop(0)
        row = {}
        for kind in CLASSES:
            steps = [p.step(s, kind) for p, s in zip(parts, state)]
            to = tuple(s[0] for s in steps)
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            factor, amount = 1.0, 0.0
            for k, (_, f, a) in enumerate(steps):
                factor *= f
                if a:
                    for j, other in enumerate(steps):
                        a *= other[1] if j != k and other[1] else 1.0
                    amount += a
            row[kind] = (number[to], factor, amount)
        table.append(row)
    return 0, table


def machine(threat_amount: float = 4.0):
    return compose([insult(), threat(threat_amount), target(), negation(), reported()])


def score_clause(kinds: list[str], weights: list[float], start: int, table) -> float:
    """Score of one clause: ``weights`` are the words' own weights (0 where the class has none)."""
    state, total = start, 0.0
    for kind, w in zip(kinds, weights):
        state, factor, amount = table[state][kind]
        total += w * factor + amount
    return total
