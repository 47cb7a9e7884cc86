import random

import pytest

from dimsmith.llm import toxicity_grammar as op

from . import brute


def test_transducers():
    assert op.negated("oNoIoooI") == "oNonoooI"
    assert op.negated("NNooooI") == "NNooooI"
    assert op.reported("IoRoIoI") == "IoRoror"
    assert op.negated("HNooHH") == "HNoohH" and op.reported("HRoHI") == "HRoqr"
    assert op.target("YooI") == "YooT" and op.target("YoooooI") == "YoooooI" and op.target("HoY") == "KoY"


def composed(symbols):
    """The three transducers at once, position by position, from their definition."""
    out = []
    for k, s in enumerate(symbols):
        told = "R" in symbols[:k]
        back = symbols[max(0, k - op.NEGATION_REACH):k]
        if s in "IH":
            denied = "N" in back
            if denied:
                s = "n" if s == "I" else "h"
            elif told:
                s = "r" if s == "I" else "q"
            elif "Y" in symbols[max(0, k - op.TARGET_REACH):k + op.TARGET_REACH + 1]:
                s = "T" if s == "I" else "K"
        out.append(s)
    return "".join(out)


def test_composition_equals_its_definition():
    rnd = random.Random(2)
    for _ in range(3000):
        symbols = "".join(rnd.choice("IHYNRooo") for _ in range(rnd.randint(0, 14)))
        assert op.target(op.reported(op.negated(symbols))) == composed(symbols), symbols


def test_clauses_not_isolated_words():
    g = op.Grammar()
    plain, aimed, denied, quoted = (g.score(t) for t in (
        "what an idiot", "you are an idiot", "that is not an idiot at all", "the report said idiot"))
    assert aimed > plain > denied and plain > quoted
    assert g.score("you are kind. this idiot") == g.score("this idiot") < aimed
    assert g.score("i will kill you") > g.score("how to kill a process") > g.score("hello")
    for threat in ("kill", "hurt"):
        said = [g.score(t) for t in (f"i will {threat} you", f"i will not {threat} you", f"he said he will {threat} you",
                                     f"you don't {threat} them")]
        assert said[0] > 0.5 > max(said[1:])
    assert g.score(None) == g.score("") == g.score("nothing here") < 0.5


@pytest.fixture(scope="module")
def made(session):
    """Toxic documents hold inflected forms of made-up stems; negated and reported ones are clean."""
    rnd = random.Random(9)
    filler = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    ends = ["en", "ung", "ado", "ique", "s", "er"]
    some = lambda n: " ".join(rnd.choice(filler) for _ in range(n))
    rows, labels = [], []
    for d in range(900):
        bad = rnd.choice(["zorkel", "blibbr"]) + rnd.choice(ends)
        kind = rnd.choice(["toxic", "negated", "reported", "clean", "clean"])
        text = {"toxic": f"{some(8)} {bad} {some(8)}", "negated": f"{some(8)} not {bad}. {some(8)}",
                "reported": f"{some(8)} said {bad} {some(8)}", "clean": some(17)}[kind]
        rows.append((d, text))
        labels.append((d, 1, int(kind == "toxic")))
    return (session.createDataFrame(rows, "doc_id long, text string"),
            session.createDataFrame(labels, "doc_id long, quality int, toxic int"), {d: y for d, _, y in labels})


def test_held_out_accuracy(made):
    docs, labels, truth = made
    got = op.report(docs, labels).collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 100
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert right >= 0.95 * len(held)
    assert all(r.held_out == (brute.fold(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.5) for r in got)


def test_held_out_labels_are_never_used(made, session):
    docs, labels, _ = made
    flipped = labels.selectExpr("doc_id", "quality", "if(pmod(crc32(cast(cast(doc_id as string) as binary)), 5) = 0, "
                                "1 - toxic, toxic) as toxic")
    a = {r.doc_id: r.score for r in op.report(docs, labels).collect()}
    b = {r.doc_id: r.score for r in op.report(docs, flipped).collect()}
    assert a == b


def test_copies_prove_nothing(session):
    """One toxic document copied often: its ordinary rare words stay out of the lexicon."""
    rnd = random.Random(1)
    filler = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows = [(d, " ".join(rnd.choice(filler) for _ in range(20))) for d in range(400)]
    rows += [(1000 + d, "rarely seen passage of quaint unusual wording " + rows[0][1]) for d in range(60)]
    labels = [(d, int(d >= 1000)) for d, _ in rows]
    g = op.learn(session.createDataFrame(rows, "doc_id long, text string"),
                 session.createDataFrame(labels, "doc_id long, toxic int"))
    assert not any(e.startswith(("quai", "unus", "rare")) for e in g.lexicon)


def test_verdicts_above_the_bound_are_those_below(session):
    """A threat word of every toxic and of some clean documents: one class in ten is toxic, whatever the sample's ratio."""
    rnd = random.Random(4)
    filler = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    some = lambda n: " ".join(rnd.choice(filler) for _ in range(n))
    rows = [(d, f"{some(6)} {'kill' if d % 10 == 0 or d % 4 == 1 else 'word'} {some(6)}") for d in range(2400)]
    docs = session.createDataFrame(rows, "doc_id long, text string")
    labels = session.createDataFrame([(d, int(d % 10 == 0)) for d, _ in rows], "doc_id long, toxic int")
    below, above = ({r.doc_id: r.score for r in op.report(docs, labels, rows=n).collect()} for n in (op.LEARN_ROWS, 240))
    assert sum((below[d] >= 0.5) != (above[d] >= 0.5) for d in below) == 0
    assert max(abs(below[d] - above[d]) for d in below) < 0.15


def test_seed_insults_stay_beside_learned_ones(made, session):
    docs, labels, _ = made
    g = op.learn(docs, labels)
    assert any(e.startswith("zork") for e in g.lexicon) and g.lexicon["idiot"] == 1.0
    assert g.score("you are a worthless idiot") >= 0.5 > g.score("you are a gentle person")
    # Labels that speak against one seed remove that seed only.
    harmless = [(10_000 + d, f"a dumb terminal number {'abcdefghij'[d % 10]}") for d in range(150)]
    more = docs.unionByName(session.createDataFrame(harmless, "doc_id long, text string"))
    said = labels.unionByName(session.createDataFrame([(d, 1, 0) for d, _ in harmless], labels.schema))
    g = op.learn(more, said)
    assert "dumb" not in g.lexicon and g.lexicon["idiot"] == 1.0


def test_hard_rows(hard, hard_rows, none, session):
    labels = session.createDataFrame([(1, 1, 1), (1, 0, 0), (None, 1, 1), (2, None, None)],
                                     "doc_id long, quality int, toxic int")
    got = op.report(hard, labels).collect()
    assert len(got) == len(hard_rows) and all(0 <= r.score <= 1 for r in got)
    assert op.report(none, labels).collect() == []
    assert op.report(hard, labels.where("false")).count() == len(hard_rows)
