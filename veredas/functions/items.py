"""Column functions over items: summaries, title tokens, legal acts, numbers in local notation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veredas.functions.text import collapse_spaces, words

# Words of a title that carry no topic, folded, of three letters or more (shorter ones are no tokens at all).
STOPWORDS = (
    "algo algun alguna algunas alguno algunos ante antes aqui asi aunque bajo bien cada casi como con contra cual cuales cuando cuanto "
    "del desde donde durante ella ellas ellos entre era eran eres esa esas ese eso esos esta estaba estaban estado estan estar estas "
    "este esto estos estoy fue fueron han has hasta hay haya hubo las les los mas mis mucho muchos muy nada nos nosotras nosotros "
    "nuestra nuestras nuestro nuestros otra otras otro otros para pero poco por porque que qué quien quienes sea sean segun ser sido "
    "siempre sin sobre sois solo somos son soy sus tambien tan tanto tiene tienen todo todos tras tus una unas uno unos vosotras "
    "vosotros vuestra vuestras vuestro vuestros the and for with from are was were been being lunes martes miercoles jueves viernes "
    "sabado domingo enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre"
).split()
# Months by name.
MONTHS = "enero febrero marzo abril mayo junio julio agosto septiembre setiembre octubre noviembre diciembre".split()
#: Kinds of legal acts by the words that name them, folded; and the words that may stand between kind and number.
ACTS = {
    "acto legislativo": "acto legislativo", "acuerdo": "acuerdo", "circular": "circular", "circular conjunta": "circular conjunta",
    "circular externa": "circular externa", "concepto": "concepto", "decreto": "decreto", "decreto ley": "decreto ley",
    "directiva": "directiva", "ley": "ley", "res": "resolucion", "resolucion": "resolucion",
}
NUMBER_WORDS = ["n", "no", "nro", "num", "numero"]
#: One to three words, a number, and a year, perhaps with a day and month before it: the shape of a citation, whatever it cites.
CITED = (
    r"((?:\p{L}+[.\s-]+){1,3})([A-Za-z]?[0-9]{1,6}(?:[-/][0-9]{1,5})?)\s*del?\s+"
    r"(?:[0-9]{1,2}[°º]?\s+(?:de\s+)?\p{L}{4,10}\s+(?:de\s+)?)?((?:19|20)[0-9]{2})\b"
)


def truncate_summary(text: Column, limit: int = 280) -> Column:
    """Texts beyond ``limit`` characters are cut at the last space, if it is not in the first 60 percent, and end in an ellipsis."""
    cut = F.substring(text, 1, limit)
    space = F.length(cut) - F.instr(F.reverse(cut), " ")
    at_space = (F.instr(cut, " ") > 0) & (space >= limit * 0.6)
    kept = F.when(at_space, F.substring(cut, F.lit(1), space)).otherwise(cut)
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.rtrim(kept, F.lit(" ,.;:-")), F.lit("…")))


def title_tokens(title: Column) -> Column:
    """Distinct folded words of more than two characters that are no stop words, sorted."""
    stop = F.array(*[F.lit(w) for w in STOPWORDS])
    return F.array_sort(F.array_distinct(F.filter(words(title), lambda w: (F.length(w) > 2) & ~F.array_contains(stop, w))))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all elements of two distinct-element arrays; 0 if both are empty."""
    shared = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - shared
    return F.when(every > 0, shared / every).otherwise(F.lit(0.0))


def legal_acts(text: Column) -> Column:
    """Distinct acts named in a text, in order: array of (kind, number, year), kinds folded, numbers without leading zeros.

    The text is searched once, for citations of anything; what is cited is then looked up by the last two words before the number, else by the last.
    """
    cited = F.regexp_extract_all(collapse_spaces(text), F.lit(CITED), 0)
    part = lambda c, i: F.regexp_extract(c, CITED, i)
    acts = F.transform(
        cited, lambda c: F.struct(act_kind(part(c, 1)).alias("kind"), act_number(part(c, 2)).alias("number"), part(c, 3).alias("year"))
    )
    return F.array_distinct(F.filter(acts, lambda a: a.getItem("kind").isNotNull()))


def act_kind(before: Column) -> Column:
    """Canonical kind of the act that the words before a number name, null if they name none."""
    known = F.create_map(*[F.lit(x) for pair in ACTS.items() for x in pair])
    named = F.filter(words(before), lambda w: ~w.isin(NUMBER_WORDS))
    last = lambda n: F.array_join(F.slice(named, -n, n), " ")
    return F.when(F.size(named) > 1, F.coalesce(F.element_at(known, last(2)), F.element_at(known, last(1)))).when(
        F.size(named) == 1, F.element_at(known, last(1))
    )


def act_number(written: Column) -> Column:
    """Number of an act in capitals, its parts joined by hyphens and without leading zeros."""
    parts = F.split(F.translate(F.upper(written), "/", "-"), "-")
    return F.array_join(F.transform(parts, lambda p: F.regexp_replace(p, "^0+(?=.)", "")), "-")


def number_in_text(text: Column) -> Column:
    """Number of a field: of comma and point the last is the decimal mark; a comma alone is one if two digits or fewer follow."""
    bare = F.regexp_replace(text, r"[^0-9,.\-]", "")
    comma, point = F.instr(F.reverse(bare), ","), F.instr(F.reverse(bare), ".")
    decimal_comma = F.regexp_replace(F.regexp_replace(bare, r"\.", ""), ",", ".")
    return (
        F.when((comma > 0) & (point > 0) & (comma < point), decimal_comma)
        .when((comma > 0) & ((point > 0) | (comma > 3)), F.regexp_replace(bare, ",", ""))
        .when(comma > 0, F.regexp_replace(bare, ",", "."))
        .otherwise(bare)
        .try_cast("double")
    )


def number_in_series(text: Column) -> Column:
    """Number of a published series: as :func:`number_in_text`, but one point before three digits groups thousands."""
    bare = F.regexp_replace(F.regexp_replace(text, r"\s", ""), r"^[.,]+|[.,]+$", "")
    comma, point = F.instr(F.reverse(bare), ","), F.instr(F.reverse(bare), ".")
    return (
        F.when((comma > 0) & (point > 0) & (comma < point), F.regexp_replace(F.regexp_replace(bare, r"\.", ""), ",", "."))
        .when((comma > 0) & (point > 0), F.regexp_replace(bare, ",", ""))
        .when(comma > 0, F.regexp_replace(bare, ",", "."))
        .when(bare.rlike(r"^-?[0-9]{1,3}\.[0-9]{3}$") | bare.rlike(r"\..*\."), F.regexp_replace(bare, r"\.", ""))
        .otherwise(bare)
        .try_cast("double")
    )


def stable_id(source: Column, url_key: Column, title: Column) -> Column:
    """16 hex digits that depend on the source, the canonical URL and the title alone; null parts count as empty."""
    parts = [F.coalesce(c, F.lit("")) for c in (source, url_key, title)]
    return F.left(F.sha1(F.concat_ws("|", *parts)), F.lit(16))
