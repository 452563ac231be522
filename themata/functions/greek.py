"""Greek stemmer as one Column expression (suffix rules after Ntais 2006, "Development of a
Stemmer for the Greek Language").

A rule cuts an ending and, for listed stems, puts part of it back. The rules are a table; they
are folded into one expression, so a token array is stemmed where it lies: no Python worker, no
shuffle, no vocabulary join. Words that are short, not Greek or protected skip the
whole chain.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from themata.cluster import sql_list, unnest

VOWELS = "ΑΕΗΙΟΥΩ"
VOWELS_WITHOUT_Y = "ΑΕΗΙΟΩ"
#: The range pattern of an upper-cased Greek word; the last sign lower-cases into the range.
GREEK_WORD = "^[Α-Ωα-ωϴ]+$"
MIN_CHARS = 3


@dataclass(frozen=True)
class PutBack:
    """``text`` goes back on a stem that equals one of ``whole``, ends on one of ``ends`` or on
    one of the letters ``vowel``, or is shorter than ``shorter``; never if ``not_whole`` or
    ``not_ends`` holds. ``always`` needs no condition."""

    text: str
    whole: str = ""
    ends: str = ""
    vowel: str = ""
    shorter: int = 0
    not_whole: str = ""
    not_ends: str = ""
    always: bool = False


@dataclass(frozen=True)
class Rule:
    """Cut the longest of ``endings``; the first ``put_back`` that applies is added.

    ``keep`` lists stems for which nothing is cut. ``if_same_length`` runs the rule only when the
    word still has its first length.
    """

    step: str
    endings: str
    put_back: tuple[PutBack, ...] = ()
    keep: str = ""
    if_same_length: bool = False


# Fixed values. Step 1: the stem that remains, then the endings cut from it.
IRREGULAR = """
ΦΑ      ΓΙΑ ΓΙΟΥ ΓΙΩΝ
ΣΚΑ     ΓΙΑ ΓΙΟΥ ΓΙΩΝ
ΣΟ      ΓΙΟΥ ΓΙΑ ΓΙΩΝ
ΤΑΤΟ    ΓΙΑ ΓΙΟΥ ΓΙΩΝ
ΚΡΕ     ΑΣ ΑΤΟΣ ΑΤΑ ΑΤΩΝ
ΠΕΡ     ΑΣ ΑΤΟΣ ΑΤΑ ΑΤΩΝ
ΤΕΡ     ΑΣ ΑΤΟΣ ΑΤΑ ΑΤΩΝ
ΦΩ      Σ ΤΟΣ ΤΑ ΤΩΝ
ΚΑΘΕΣΤ  ΩΣ ΩΤΟΣ ΩΤΑ ΩΤΩΝ
ΓΕΓΟΝ   ΟΣ ΟΤΟΣ ΟΤΑ ΟΤΩΝ
"""

# Fixed values. Step 5a has one word with its own stem.
SPECIAL_WORD, SPECIAL_STEM = "ΑΓΑΜΕ", "ΑΓΑΜ"

# Fixed values. Steps 2a to 7: endings, what goes back, and for which stems.
RULES = (
    Rule("2a", "ΑΔΕΣ ΑΔΩΝ", (
        PutBack("ΑΔ", always=True, not_ends=(
            "ΟΚ ΜΑΜ ΜΑΝ ΜΠΑΜΠ ΠΑΤΕΡ ΓΙΑΓΙ ΝΤΑΝΤ ΚΥΡ ΘΕΙ ΠΕΘΕΡ ΜΟΥΣΑΜ ΚΑΠΛΑΜ ΠΑΡ ΨΑΡ ΤΖΟΥΡ ΤΑΜΠΟΥΡ")),)),
    Rule("2b", "ΕΔΕΣ ΕΔΩΝ", (PutBack("ΕΔ", ends="ΟΠ ΙΠ ΕΜΠ ΥΠ ΓΗΠ ΔΑΠ ΚΡΑΣΠ ΜΙΛ"),)),
    Rule("2c", "ΟΥΔΕΣ ΟΥΔΩΝ", (
        PutBack("ΟΥΔ", ends="ΑΡΚ ΚΑΛΙΑΚ ΠΕΤΑΛ ΛΙΧ ΠΛΕΞ ΣΚ Σ ΦΛ ΦΡ ΒΕΛ ΛΟΥΛ ΧΝ ΣΠ ΤΡΑΓ ΦΕ"),)),
    Rule("2d", "ΕΩΣ ΕΩΝ ΕΑΣ ΕΑ", (
        PutBack("Ε", whole="Θ Δ ΕΛ ΓΑΛ Ν Π ΙΔ ΠΑΡ ΣΤΕΡ ΟΡΦ ΑΝΔΡ ΑΝΤΡ"),)),
    Rule("3", "ΙΟΥΣ ΙΑΣ ΙΕΣ ΙΟΣ ΙΟΥ ΙΟΙ ΙΩΝ ΙΟΝ ΙΑ ΙΟ", (
        PutBack("Ι", vowel=VOWELS, shorter=2, whole=(
            "ΑΓ ΑΓΓΕΛ ΑΓΡ ΑΕΡ ΑΘΛ ΑΚΟΥΣ ΑΞ ΑΣ Β ΒΙΒΛ ΒΥΤ Γ ΓΙΑΓ ΓΩΝ Δ ΔΑΝ ΔΗΛ ΔΗΜ ΔΟΚΙΜ ΕΛ ΖΑΧΑΡ ΗΛ ΗΠ "
            "ΙΔ ΙΣΚ ΙΣΤ ΙΟΝ ΙΩΝ ΚΙΜΩΛ ΚΟΛΟΝ ΚΟΡ ΚΤΗΡ ΚΥΡ ΛΑΓ ΛΟΓ ΜΑΓ ΜΠΑΝ ΜΠΡ ΝΑΥΤ ΝΟΤ ΟΠΑΛ ΟΞ ΟΡ ΟΣ "
            "ΠΑΝΑΓ ΠΑΤΡ ΠΗΛ ΠΗΝ ΠΛΑΙΣ ΠΟΝΤ ΡΑΔ ΡΟΔ ΣΚ ΣΚΟΡΠ ΣΟΥΝ ΣΠΑΝ ΣΤΑΔ ΣΥΡ ΤΗΛ ΤΙΜ ΤΟΚ ΤΟΠ ΤΡΟΧ ΦΙΛ "
            "ΦΩΤ Χ ΧΙΛ ΧΡΩΜ ΧΩΡ")),
        PutBack("ΑΙ", whole="ΠΑΛ"))),
    Rule("4", "ΙΚΟΣ ΙΚΟΝ ΙΚΕΙΣ ΙΚΟΙ ΙΚΕΣ ΙΚΟΥΣ ΙΚΗ ΙΚΗΣ ΙΚΟ ΙΚΑ ΙΚΟΥ ΙΚΩΝ ΙΚΩΣ", (
        PutBack("ΙΚ", vowel=VOWELS, ends="ΦΟΙΝ", whole=(
            "ΑΔ ΑΛ ΑΜΑΝ ΑΜΕΡ ΑΜΜΟΧΑΛ ΑΝΗΘ ΑΝΤΙΔ ΑΠΛ ΑΤΤ ΑΦΡ ΒΑΣ ΒΡΩΜ ΓΕΝ ΓΕΡ Δ ΔΥΤ ΕΙΔ ΕΝΔ ΕΞΩΔ ΗΘ ΘΕΤ "
            "ΚΑΛΛΙΝ ΚΑΛΠ ΚΑΤΑΔ ΚΡ ΚΩΔ ΛΟΓ Μ ΜΕΡ ΜΟΝΑΔ ΜΟΥΛ ΜΟΥΣ ΜΠΑΓΙΑΤ ΜΠΑΝ ΜΠΟΛ ΜΠΟΣ ΜΥΣΤ Ν ΝΙΤ ΞΙΚ ΟΠΤ "
            "ΠΑΝ ΠΕΤΣ ΠΙΚΑΝΤ ΠΙΤΣ ΠΛΑΣΤ ΠΛΙΑΤΣ ΠΟΝΤ ΠΟΣΤΕΛΝ ΠΡΩΤΟΔ ΣΕΡΤ ΣΗΜΑΝΤ ΣΤΑΤ ΣΥΝΑΔ ΣΥΝΟΜΗΛ ΤΕΛ ΤΕΧΝ "
            "ΤΡΟΠ ΤΣΑΜ ΥΠΟΔ Φ ΦΙΛΟΝ ΦΥΛΟΔ ΦΥΣ ΧΑΣ")),)),
    Rule("5a", "ΑΓΑΜΕ ΗΣΑΜΕ ΟΥΣΑΜΕ ΗΚΑΜΕ ΗΘΗΚΑΜΕ"),
    Rule("5a2", "ΑΜΕ", (PutBack("ΑΜ", whole="ΑΝΑΠ ΑΠΟΘ ΑΠΟΚ ΑΠΟΣΤ ΒΟΥΒ ΞΕΘ ΟΥΛ ΠΕΘ ΠΙΚΡ ΠΟΤ ΣΙΧ Χ"),)),
    Rule("5b", "ΑΓΑΝΕ ΗΣΑΝΕ ΟΥΣΑΝΕ ΙΟΝΤΑΝΕ ΙΟΤΑΝΕ ΙΟΥΝΤΑΝΕ ΟΝΤΑΝΕ ΟΤΑΝΕ ΟΥΝΤΑΝΕ ΗΚΑΝΕ ΗΘΗΚΑΝΕ", (
        PutBack("ΑΓΑΝ", whole="ΤΡ ΤΣ"),)),
    Rule("5b2", "ΑΝΕ", (
        PutBack("ΑΝ", vowel=VOWELS_WITHOUT_Y, whole=(
            "ΒΕΤΕΡ ΒΟΥΛΚ ΒΡΑΧΜ Γ ΔΡΑΔΟΥΜ Θ ΚΑΛΠΟΥΖ ΚΑΣΤΕΛ ΚΟΡΜΟΡ ΛΑΟΠΛ ΜΩΑΜΕΘ Μ ΜΟΥΣΟΥΛΜ Ν ΟΥΛ Π ΠΕΛΕΚ ΠΛ "
            "ΠΟΛΙΣ ΠΟΡΤΟΛ ΣΑΡΑΚΑΤΣ ΣΟΥΛΤ ΤΣΑΡΛΑΤ ΟΡΦ ΤΣΙΓΓ ΤΣΟΠ ΦΩΤΟΣΤΕΦ Χ ΨΥΧΟΠΛ ΑΓ ΓΑΛ ΓΕΡ ΔΕΚ ΔΙΠΛ "
            "ΑΜΕΡΙΚΑΝ ΟΥΡ ΠΙΘ ΠΟΥΡΙΤ Σ ΖΩΝΤ ΙΚ ΚΑΣΤ ΚΟΠ ΛΙΧ ΛΟΥΘΗΡ ΜΑΙΝΤ ΜΕΛ ΣΙΓ ΣΠ ΣΤΕΓ ΤΡΑΓ ΤΣΑΓ Φ ΕΡ ΑΔΑΠ "
            "ΑΘΙΓΓ ΑΜΗΧ ΑΝΙΚ ΑΝΟΡΓ ΑΠΗΓ ΑΠΙΘ ΑΤΣΙΓΓ ΒΑΣ ΒΑΣΚ ΒΑΘΥΓΑΛ ΒΙΟΜΗΧ ΒΡΑΧΥΚ ΔΙΑΤ ΔΙΑΦ ΕΝΟΡΓ ΘΥΣ "
            "ΚΑΠΝΟΒΙΟΜΗΧ ΚΑΤΑΓΑΛ ΚΛΙΒ ΚΟΙΛΑΡΦ ΛΙΒ ΜΕΓΛΟΒΙΟΜΗΧ ΜΙΚΡΟΒΙΟΜΗΧ ΝΤΑΒ ΞΗΡΟΚΛΙΒ ΟΛΙΓΟΔΑΜ ΟΛΟΓΑΛ "
            "ΠΕΝΤΑΡΦ ΠΕΡΗΦ ΠΕΡΙΤΡ ΠΛΑΤ ΠΟΛΥΔΑΠ ΠΟΛΥΜΗΧ ΣΤΕΦ ΤΑΒ ΤΕΤ ΥΠΕΡΗΦ ΥΠΟΚΟΠ ΧΑΜΗΛΟΔΑΠ ΨΗΛΟΤΑΒ")),)),
    Rule("5c", "ΗΣΕΤΕ"),
    Rule("5c2", "ΕΤΕ", (
        PutBack("ΕΤ", vowel=VOWELS_WITHOUT_Y,
                ends=("ΟΔ ΑΙΡ ΦΟΡ ΤΑΘ ΔΙΑΘ ΣΧ ΕΝΔ ΕΥΡ ΤΙΘ ΥΠΕΡΘ ΡΑΘ ΕΝΘ ΡΟΘ ΣΘ ΠΥΡ ΑΙΝ ΣΥΝΔ ΣΥΝ ΣΥΝΘ ΧΩΡ ΠΟΝ ΒΡ "
                      "ΚΑΘ ΕΥΘ ΕΚΘ ΝΕΤ ΡΟΝ ΑΡΚ ΒΑΡ ΒΟΛ ΩΦΕΛ"),
                whole=("ΑΒΑΡ ΒΕΝ ΕΝΑΡ ΑΒΡ ΑΔ ΑΘ ΑΝ ΑΠΛ ΒΑΡΟΝ ΝΤΡ ΣΚ ΚΟΠ ΜΠΟΡ ΝΙΦ ΠΑΓ ΠΑΡΑΚΑΛ ΣΕΡΠ ΣΚΕΛ ΣΥΡΦ ΤΟΚ "
                       "Υ Δ ΕΜ ΘΑΡΡ Θ")),)),
    Rule("5d", "ΟΝΤΑΣ ΩΝΤΑΣ", (PutBack("ΟΝΤ", whole="ΑΡΧ"), PutBack("ΩΝΤ", ends="ΚΡΕ"))),
    Rule("5e", "ΟΜΑΣΤΕ ΙΟΜΑΣΤΕ", (PutBack("ΟΜΑΣΤ", whole="ΟΝ"),)),
    Rule("5f", "ΙΕΣΤΕ", (PutBack("ΙΕΣΤ", whole="Π ΑΠ ΣΥΜΠ ΑΣΥΜΠ ΑΚΑΤΑΠ ΑΜΕΤΑΜΦ"),)),
    Rule("5f2", "ΕΣΤΕ", (PutBack("ΕΣΤ", whole="ΑΛ ΑΡ ΕΚΤΕΛ Ζ Μ Ξ ΠΑΡΑΚΑΛ ΠΡΟ ΝΙΣ"),)),
    Rule("5g", "ΗΘΗΚΑ ΗΘΗΚΕΣ ΗΘΗΚΕ"),
    Rule("5g2", "ΗΚΑ ΗΚΕΣ ΗΚΕ", (
        PutBack("ΗΚ", ends="ΣΚΩΛ ΣΚΟΥΛ ΝΑΡΘ ΣΦ ΟΘ ΠΙΘ", whole="ΔΙΑΘ Θ ΠΑΡΑΚΑΤΑΘ ΠΡΟΣΘ ΣΥΝΘ"),)),
    Rule("5h", "ΟΥΣΑ ΟΥΣΕΣ ΟΥΣΕ", (
        PutBack("ΟΥΣ", vowel=VOWELS,
                whole=("ΦΑΡΜΑΚ ΧΑΔ ΑΓΚ ΑΝΑΡΡ ΒΡΟΜ ΕΚΛΙΠ ΛΑΜΠΙΔ ΛΕΧ Μ ΠΑΤ Ρ Λ ΜΕΔ ΜΕΣΑΖ ΥΠΟΤΕΙΝ ΑΜ ΑΙΘ ΑΝΗΚ "
                       "ΔΕΣΠΟΖ ΕΝΔΙΑΦΕΡ ΔΕ ΔΕΥΤΕΡΕΥ ΚΑΘΑΡΕΥ ΠΛΕ ΤΣΑ"),
                ends="ΠΟΔΑΡ ΒΛΕΠ ΠΑΝΤΑΧ ΦΡΥΔ ΜΑΝΤΙΛ ΜΑΛΛ ΚΥΜΑΤ ΛΑΧ ΛΗΓ ΦΑΓ ΟΜ ΠΡΩΤ"),)),
    Rule("5i", "ΑΓΑ ΑΓΕΣ ΑΓΕ", (
        PutBack("ΑΓ", not_whole="ΨΟΦ ΝΑΥΛΟΧ", not_ends="ΚΟΛΛ",
                whole=("ΑΒΑΣΤ ΠΟΛΥΦ ΑΔΗΦ ΠΑΜΦ Ρ ΑΣΠ ΑΦ ΑΜΑΛ ΑΜΑΛΛΙ ΑΝΥΣΤ ΑΠΕΡ ΑΣΠΑΡ ΑΧΑΡ ΔΕΡΒΕΝ ΔΡΟΣΟΠ ΞΕΦ "
                       "ΝΕΟΠ ΝΟΜΟΤ ΟΛΟΠ ΟΜΟΤ ΠΡΟΣΤ ΠΡΟΣΩΠΟΠ ΣΥΜΠ ΣΥΝΤ Τ ΥΠΟΤ ΧΑΡ ΑΕΙΠ ΑΙΜΟΣΤ ΑΝΥΠ ΑΠΟΤ ΑΡΤΙΠ "
                       "ΔΙΑΤ ΕΝ ΕΠΙΤ ΚΡΟΚΑΛΟΠ ΣΙΔΗΡΟΠ Λ ΝΑΥ ΟΥΛΑΜ ΟΥΡ Π ΤΡ Μ"),
                ends="ΟΦ ΠΕΛ ΧΟΡΤ ΛΛ ΣΦ ΡΠ ΦΡ ΠΡ ΛΟΧ ΣΜΗΝ"),)),
    Rule("5j", "ΗΣΕ ΗΣΟΥ ΗΣΑ", (PutBack("ΗΣ", whole="Ν ΧΕΡΣΟΝ ΔΩΔΕΚΑΝ ΕΡΗΜΟΝ ΜΕΓΑΛΟΝ ΕΠΤΑΝ Ι"),)),
    Rule("5k", "ΗΣΤΕ", (PutBack("ΗΣΤ", whole="ΑΣΒ ΣΒ ΑΧΡ ΧΡ ΑΠΛ ΑΕΙΜΝ ΔΥΣΧΡ ΕΥΧΡ ΚΟΙΝΟΧΡ ΠΑΛΙΜΨ"),)),
    Rule("5l", "ΟΥΝΕ ΗΣΟΥΝΕ ΗΘΟΥΝΕ", (
        PutBack("ΟΥΝ", whole="Ν Ρ ΣΠΙ ΣΤΡΑΒΟΜΟΥΤΣ ΚΑΚΟΜΟΥΤΣ ΕΞΩΝ"),)),
    Rule("5m", "ΟΥΜΕ ΗΣΟΥΜΕ ΗΘΟΥΜΕ", (
        PutBack("ΟΥΜ", whole="ΠΑΡΑΣΟΥΣ Φ Χ ΩΡΙΟΠΛ ΑΖ ΑΛΛΟΣΟΥΣ ΑΣΟΥΣ"),)),
    Rule("6a", "ΜΑΤΟΙ ΜΑΤΟΥΣ ΜΑΤΟ ΜΑΤΑ ΜΑΤΩΣ ΜΑΤΩΝ ΜΑΤΟΣ ΜΑΤΕΣ ΜΑΤΗ ΜΑΤΗΣ ΜΑΤΟΥ", (
        PutBack("ΜΑ", whole="ΓΡΑΜ"), PutBack("ΜΑΤ", whole="ΓΕ ΣΤΑ"), PutBack("Μ", always=True))),
    Rule("6b", (
        "Α ΑΓΑΤΕ ΑΓΑΝ ΑΕΙ ΑΜΑΙ ΑΝ ΑΣ ΑΣΑΙ ΑΤΑΙ ΑΩ Ε ΕΙ ΕΙΣ ΕΙΤΕ ΕΣΑΙ ΕΣ ΕΤΑΙ Ι ΙΕΜΑΙ ΙΕΜΑΣΤΕ ΙΕΤΑΙ ΙΕΣΑΙ "
        "ΙΕΣΑΣΤΕ ΙΟΜΑΣΤΑΝ ΙΟΜΟΥΝ ΙΟΜΟΥΝΑ ΙΟΝΤΑΝ ΙΟΝΤΟΥΣΑΝ ΙΟΣΑΣΤΑΝ ΙΟΣΑΣΤΕ ΙΟΣΟΥΝ ΙΟΣΟΥΝΑ ΙΟΤΑΝ ΙΟΥΜΑ "
        "ΙΟΥΜΑΣΤΕ ΙΟΥΝΤΑΙ ΙΟΥΝΤΑΝ Η ΗΔΕΣ ΗΔΩΝ ΗΘΕΙ ΗΘΕΙΣ ΗΘΕΙΤΕ ΗΘΗΚΑΤΕ ΗΘΗΚΑΝ ΗΘΟΥΝ ΗΘΩ ΗΚΑΤΕ ΗΚΑΝ ΗΣ ΗΣΑΝ "
        "ΗΣΑΤΕ ΗΣΕΙ ΗΣΕΣ ΗΣΟΥΝ ΗΣΩ Ο ΟΙ ΟΜΑΙ ΟΜΑΣΤΑΝ ΟΜΟΥΝ ΟΜΟΥΝΑ ΟΝΤΑΙ ΟΝΤΑΝ ΟΝΤΟΥΣΑΝ ΟΣ ΟΣΑΣΤΑΝ ΟΣΑΣΤΕ "
        "ΟΣΟΥΝ ΟΣΟΥΝΑ ΟΤΑΝ ΟΥ ΟΥΜΑΙ ΟΥΜΑΣΤΕ ΟΥΝ ΟΥΝΤΑΙ ΟΥΝΤΑΝ ΟΥΣ ΟΥΣΑΝ ΟΥΣΑΤΕ Υ ΥΣ Ω ΩΝ ΟΙΣ"),
        if_same_length=True),
    Rule("7", "ΕΣΤΕΡ ΕΣΤΑΤ ΟΤΕΡ ΟΤΑΤ ΥΤΕΡ ΥΤΑΤ ΩΤΕΡ ΩΤΑΤ", (
        PutBack("ΥΤ", whole="ΚΑ Μ ΕΛΕ ΛΕ ΔΕ"),), keep="ΕΞ ΕΣ ΑΝ ΚΑΤ Κ ΠΡ"),
)


def _by_length(words: list[str]) -> dict[int, list[str]]:
    out: dict[int, list[str]] = {}
    for word in words:
        out.setdefault(len(word), []).append(word)
    return dict(sorted(out.items(), reverse=True))


def _cut_longest(current: str, endings: str) -> str:
    """SQL for the non-empty stem in front of the longest fitting ending, else an empty string.

    One set look-up per ending length; an alternation of a hundred endings, tried at each letter,
    costs a hundred times as much.
    """
    cases = [
        f"WHEN length({current}) > {n} AND substr({current}, -{n}) IN ({sql_list(group)}) "
        f"THEN left({current}, length({current}) - {n})"
        for n, group in _by_length(endings.split()).items()
    ]
    return f"CASE {' '.join(cases)} ELSE '' END"


def _first_step(word: str) -> str:
    """SQL for step 1: an irregular noun keeps the family's stem."""
    groups: dict[tuple[int, int], list[str]] = {}
    for line in IRREGULAR.split("\n"):
        if line:
            kept, *endings = line.split()
            for ending in endings:
                groups.setdefault((len(kept + ending), len(ending)), []).append(kept + ending)
    cases = [
        f"WHEN length({word}) >= {n} AND substr({word}, -{n}) IN ({sql_list(group)}) "
        f"THEN left({word}, length({word}) - {cut})"
        for (n, cut), group in sorted(groups.items(), reverse=True)
    ]
    return f"CASE {' '.join(cases)} ELSE {word} END"


def _ends(stem: str, endings: str) -> str:
    return f"rlike({stem}, '(?:{'|'.join(endings.split())})$')"


def _applies(stem: str, put: PutBack) -> str:
    conditions = []
    if put.whole:
        conditions.append(f"{stem} IN ({sql_list(put.whole.split())})")
    if put.ends:
        conditions.append(_ends(stem, put.ends))
    if put.vowel:
        conditions.append(f"rlike({stem}, '[{put.vowel}]$')")
    if put.shorter:
        conditions.append(f"length({stem}) < {put.shorter}")
    wanted = "true" if put.always else f"({' OR '.join(conditions)})"
    if put.not_whole:
        wanted += f" AND {stem} NOT IN ({sql_list(put.not_whole.split())})"
    if put.not_ends:
        wanted += f" AND NOT {_ends(stem, put.not_ends)}"
    return wanted


def _apply_rule(word: str, current: str, rule: Rule) -> str:
    """The rule as SQL. A one-element ``transform`` names the stem, an empty stem means no match."""
    cases = [f"WHEN st = '' THEN {current}"]
    if rule.keep:
        cases.append(f"WHEN st IN ({sql_list(rule.keep.split())}) THEN {current}")
    cases += [f"WHEN {_applies('st', put)} THEN concat(st, '{put.text}')" for put in rule.put_back]
    found = _cut_longest(current, rule.endings)
    changed = f"transform(array({found}), st -> CASE {' '.join(cases)} ELSE st END)[0]"
    if rule.if_same_length:
        return f"if(length({current}) = length({word}), {changed}, {current})"
    return changed


def stem_sql(tokens: str, protected=()) -> str:
    """SQL for an array of stems; each rule is one ``transform`` over (word, current stem) pairs.

    Words that are not stemmed carry a null and pass every rule untouched. Arrays without a Greek
    word skip it all.
    """
    protected = list(protected)
    stems = f"length(w) >= {MIN_CHARS} AND rlike(w, '{GREEK_WORD}')"
    if protected:
        stems += f" AND w NOT IN ({sql_list(protected)})"
    pairs = f"transform({tokens}, w -> named_struct('w', w, 's', CASE WHEN {stems} THEN {_first_step('w')} END))"
    for rule in RULES:
        current = "p.s"
        if rule.step == "5a":
            current = f"if(p.w = '{SPECIAL_WORD}', '{SPECIAL_STEM}', p.s)"
        changed = _apply_rule("p.w", current, rule)
        pairs = f"transform({pairs}, p -> named_struct('w', p.w, 's', CASE WHEN p.s IS NOT NULL THEN {changed} END))"
    done = f"transform({pairs}, p -> coalesce(p.s, p.w))"
    return f"CASE WHEN exists({tokens}, w -> rlike(w, '{GREEK_WORD}')) THEN {done} ELSE {tokens} END"


def stem_tokens(column: str, protected=()) -> Column:
    """Stem each accent-free upper-case token of an array column in place: no shuffle, no join."""
    return F.expr(stem_sql(column, protected))


def stem_word(column: str, protected=()) -> Column:
    """Stem of one accent-free upper-case word per row."""
    return F.expr(f"({stem_sql(f'array({column})', protected)})[0]")


def stem_vocabulary(tokens: DataFrame, protected=(), column: str = "tokens") -> DataFrame:
    """``(word, stem)`` for each distinct token; the stemmer runs once per word."""
    words = unnest(tokens, [], column, "word").distinct()
    # few bytes but much work per word: keep AQE from folding the vocabulary into one task
    partitions = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = words.repartition(partitions, "word")
    return words.select("word", stem_word("word", protected).alias("stem"))
