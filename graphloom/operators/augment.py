"""Paraphrased variants of pairs by fixed phrase tables; repeatable, as choices come from a hash of question and variant."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.providers import Completer, Echo, complete, parse_reply
from ..functions.text import fill
from ..plans.staging import stage
from ..plans.workers import small

# Groups of interchangeable question phrasings, terms with alternatives, connectors with alternatives.
QUESTION_GROUPS = [
    ["Qu'est-ce que", "Que designe", "Comment definit-on", "Quelle est la notion de"],
    ["Peux-tu definir", "Donne la definition de", "Definis", "Precise ce qu'on entend par"],
    ["Quelle est la definition de", "Comment est defini(e)", "Que signifie", "Quel est le sens de"],
    ["Explique le concept de", "Decris le principe de", "Presente la notion de", "En quoi consiste"],
    ["Quel est le lien entre", "Quelle relation existe entre", "Comment sont lies", "Quel rapport y a-t-il entre"],
    ["Quelle est la difference entre", "En quoi differe", "Compare", "Distingue"],
    ["Que contient", "Quel est le contenu de", "Que prevoit", "De quoi traite"],
    ["Quels sont les principaux", "Enumere les", "Cite les", "Liste les"],
    ["Quels elements sont lies a", "Qu'est-ce qui se rapporte a", "Quels composants concernent"],
    ["Que dit l'article", "Que prevoit l'article", "Quel est le contenu de l'article", "Que stipule l'article"],
    ["Quelle obligation est prevue", "Quelle regle s'applique", "Que doit-on respecter concernant"],
    ["Resume la section", "Synthetise le contenu de", "Donne un apercu de", "Presente brievement"],
]
TERMS = {
    "comptabilite": ["tenue des comptes", "science comptable"],
    "comptes annuels": ["etats financiers annuels", "documents comptables annuels"],
    "bilan": ["etat de la situation financiere", "bilan comptable"],
    "compte de resultat": ["etat du resultat", "compte de pertes et profits"],
    "annexe": ["notes annexes", "informations complementaires"],
    "actif": ["elements d'actif", "ressources economiques"],
    "passif": ["elements de passif", "obligations"],
    "charges": ["depenses", "couts"],
    "produits": ["revenus", "recettes"],
    "amortissement": ["depreciation systematique", "repartition du cout"],
    "provision": ["dotation", "charge provisionnee"],
    "immobilisation": ["actif immobilise", "bien durable"],
    "creance": ["droit de creance", "actif a recevoir"],
    "dette": ["obligation financiere", "engagement"],
    "capitaux propres": ["fonds propres", "situation nette"],
    "PCG": ["Plan Comptable General", "le referentiel comptable francais"],
    "dans le cadre du PCG": ["selon le PCG", "au sens du PCG", "d'apres le PCG"],
    "en comptabilite francaise": ["dans le referentiel francais", "selon les normes francaises"],
    "dans le PCG 2026": ["selon le PCG 2026", "au titre du PCG 2026"],
}
CONNECTORS = [
    ("En outre,", ["De plus,", "Par ailleurs,", "Egalement,", "De surcroit,"]),
    ("De plus,", ["En outre,", "Par ailleurs,", "Aussi,", "Egalement,"]),
    ("Cependant,", ["Toutefois,", "Neanmoins,", "Pourtant,", "En revanche,"]),
    ("Ainsi,", ["De cette maniere,", "Par consequent,", "En consequence,", "Des lors,"]),
    ("C'est-a-dire", ["autrement dit", "en d'autres termes", "soit"]),
    ("Ensuite,", ["Puis,", "Apres quoi,", "Par la suite,"]),
    (" est ", [" correspond a ", " designe ", " represente "]),
    (" comprend ", [" inclut ", " englobe ", " integre "]),
    (" doit ", [" est tenu(e) de ", " a l'obligation de "]),
    (" permet de ", [" rend possible ", " offre la possibilite de "]),
]
QUESTION_TERM_CHANCE, ANSWER_TERM_CHANCE, MOST_SWAPS, TRIES = 0.3, 0.2, 2, 3


class Draw:
    """Repeatable draws: md5 of a key and a counter."""

    def __init__(self, *key: object):
        self.key, self.n = "\x1f".join(map(str, key)), 0

    def number(self) -> float:
        self.n += 1
        return int(hashlib.md5(f"{self.key}\x1f{self.n}".encode()).hexdigest()[:12], 16) / 16**12

    def one(self, of: list):
        return of[int(self.number() * len(of))]


def _terms(text: str, draw: Draw, chance: float) -> str:
    for term, others in TERMS.items():
        if term in text and draw.number() < chance:
            text = text.replace(term, draw.one(others), 1)
    return text


def paraphrase_question(text: str, draw: Draw) -> str:
    for group in QUESTION_GROUPS:
        if (said := next((p for p in group if p in text), None)) is not None:
            text = text.replace(said, draw.one([p for p in group if p != said]), 1)
    return _terms(text, draw, QUESTION_TERM_CHANCE)


def paraphrase_answer(text: str, draw: Draw) -> str:
    swaps = 0
    if not any(said in text for said, _ in CONNECTORS):
        draw.n += len(CONNECTORS)  # the draws of an order that nothing depends on
        return _terms(text, draw, ANSWER_TERM_CHANCE)
    for said, others in sorted(CONNECTORS, key=lambda c: draw.number()):
        if swaps < MOST_SWAPS and said in text:
            text, swaps = text.replace(said, draw.one(others), 1), swaps + 1
    return _terms(text, draw, ANSWER_TERM_CHANCE)


def variants(question: str, answer: str, n: int, seed: int) -> list[tuple[str, str]]:
    """At most ``n`` variants in at most TRIES * n tries, none with a question seen before."""
    out, seen = [], {question.lower().strip()}
    for attempt in range(TRIES * n):
        if len(out) >= n:
            break
        draw = Draw(seed, question, attempt)
        q, a = paraphrase_question(question, draw), paraphrase_answer(answer, draw)
        if q.lower().strip() not in seen:
            seen.add(q.lower().strip())
            out.append((q, a))
    return out


def augment(pairs: DataFrame, n: int = 3, seed: int = 0) -> DataFrame:
    """The pairs, each with its variants behind it: adds ``variant`` (0: the original) and marks metadata."""
    kinds = dict(pairs.dtypes)
    rest = [c for c in pairs.columns if c not in ("question", "answer")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches, 0, 1):
            take, qs, ans, which = [], [], [], []
            for i, (q, a) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                for v, (q2, a2) in enumerate([(q, a), *variants(q or "", a or "", n, seed)]):
                    take.append(i), qs.append(q2), ans.append(a2), which.append(v)
            others = [c.take(pa.array(take, pa.int64())) for c in b.columns[2:]]
            yield pa.RecordBatch.from_arrays([pa.array(qs, pa.string()), pa.array(ans, pa.string()), *others, pa.array(which, pa.int32())], [*b.schema.names, "variant"])

    schema = "question string, answer string, " + "".join(f"`{c}` {kinds[c]}, " for c in rest) + "variant int"
    out = pairs.select("question", "answer", *rest).mapInArrow(run, schema)
    if kinds.get("metadata") == "map<string,string>":
        out = out.withColumn("metadata", F.when(F.col("variant") > 0, F.map_concat(F.map_filter("metadata", lambda k, v: ~k.isin("augmented")), F.create_map(F.lit("augmented"), F.lit("true")))).otherwise(F.col("metadata")))
    return out


REPHRASE = """Voici une question et sa reponse, en comptabilite francaise. Redis les deux autrement, sans changer ni le sens ni les donnees techniques.
Rends seulement un objet JSON avec les champs question et answer.

Question : {question}
Reponse : {answer}"""


def augment_by_model(pairs: DataFrame, n: int = 3, make: Callable[[], Completer] = Echo, temperature: float = 0.8, step: float = 0.1, most_answer: int = 1000, tries: int = 1) -> tuple[DataFrame, DataFrame]:
    """The pairs (variant 0), then what a language model makes of each in ``n`` calls, each ``step`` warmer than the one before; and
    one row of counts: originals, variants, failed, attempts. A reply that isn't the wanted JSON, or too short, gives no variant;
    a call without an answer counts as failed."""
    calls = pairs.withColumn("attempt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))) if n > 0 else F.lit(None).cast("int")).filter("attempt is not null")
    asked = calls.withColumns({"_prompt": fill(REPHRASE, question=F.col("question"), answer=F.substring("answer", 1, most_answer)), "_heat": F.lit(float(temperature)) + F.col("attempt") * step})
    said = stage(complete(asked, "_prompt", make, temperature="_heat", tries=tries).withColumn("_r", parse_reply("completion")), "replies")
    kinds = dict(pairs.dtypes)
    fresh = said.filter("_r is not null").withColumns({"question": F.trim("_r.q"), "answer": F.trim("_r.a"), "variant": F.col("attempt") + 1})
    if kinds.get("metadata") == "map<string,string>":
        marks = F.create_map(F.lit("augmented"), F.lit("true"), F.lit("augment_method"), F.lit("model"))
        fresh = fresh.withColumn("metadata", F.map_concat(F.map_filter("metadata", lambda k, v: ~k.isin("augmented", "augment_method")), marks))
    out = pairs.withColumn("variant", F.lit(0)).unionByName(fresh.select(*pairs.columns, "variant"))
    counts = said.agg(F.count_if(F.col("_r").isNotNull()).alias("variants"), F.count_if(F.col("completion") == "").alias("failed"), F.count(F.lit(1)).alias("attempts"))
    return out, counts.crossJoin(pairs.agg(F.count(F.lit(1)).alias("originals"))).select("originals", "variants", "failed", "attempts")  # one row each


def augmenter(n: int, make: Callable[[], Completer] | None = None, seed: int = 0) -> Callable[[DataFrame], DataFrame]:
    """By a model where ``make`` gives one, else by templates."""
    return (lambda pairs: augment_by_model(pairs, n, make)[0]) if make else (lambda pairs: augment(pairs, n, seed))
