"""Text functions as columns. Each fold of accents is its own: they are not interchangeable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ACCENTED, PLAIN = "áéíóúüñÁÉÍÓÚÜÑ", "aeiouunAEIOUUN"
#: Accented letters of both cases that the tail label may be written with, one for one.
LABEL_ACCENTED = "áàäâãéèëêíìïîóòöôõúùüûñç"
LABEL_PLAIN = "aaaaaeeeeiiiiooooouuuunc"

# Words that say nothing about the subject of a text, without accents; those under four letters are no terms
# anyway and left out.
STOPWORDS = """
algo algun alguna algunas alguno algunos ambos ante antes aquel aquella
aquellas aquello aquellos aqui aunque bajo bien cada casi caso cierta
ciertas cierto ciertos como contra cual cuales cualquier cuando cuanto cuyo
demas desde despues donde durante ella ellas ello ellos
entonces entre eran esas esos esta estaba estan estar estas
este esto estos fueron gran grande grandes habia hasta hecho
incluso junto luego mayor mayores media medio
mejor menos mientras mismo misma mismas mismos mucha muchas mucho muchos
nada ningun ninguna nuestra nuestro nueva nuevas nuevo nuevos nunca
otra otras otro otros para parte pero pesar poco pocos podria porque
posible primer primera primero pudo pueda puede pueden pues queda quien
quienes sean segun segunda segundo siempre sido sino sobre
solo tambien tampoco tanto tener tenia tiene tienen toda
todas todo todos tras tres tuvo unas unos veces
anos actual actualmente ademas ahora ambas anterior aparte apenas
cosa cosas dado debe deben decir dice dicho ejemplo estado estados
forma formas hacer hace hacia lado lugar manera modo momento nivel
niveles parece pasado proceso punto respecto resulta seria sera sigue
situacion tema temas tiempo tipo vista haber
""".split()


# What ends a phrase, and what a word is.
PHRASE_END, WORD = r'[.;:!?¡¿()\[\]«»"\n]+', "(?iu)[a-záéíóúüñ]{4,}"


def fold_word(c: Column) -> Column:
    """Without the accents that a word of the term pattern can have."""
    return F.translate(F.lower(c), "áéíóúüñ", "aeiouun")


def fold_name(c: Column) -> Column:
    return F.lower(F.translate(c, ACCENTED, PLAIN))


def fold_marker(c: Column) -> Column:
    return F.translate(F.lower(c), "áéíóúüñ", "aeiouun")


def fold_label(c: Column) -> Column:
    """Keeps the length."""
    return F.translate(F.lower(c), LABEL_ACCENTED, LABEL_PLAIN)


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def words_in(column: str) -> Column:
    return F.split(F.lower(F.coalesce(F.col(column), F.lit(""))), "[^a-z]+")


def terms(text: Column, stopwords: list[str] = STOPWORDS) -> Column:
    """Distinct words of four letters or more and pairs of them next to each other within a phrase; neither may be a
    stopword. Everything stays in one row: no shuffle."""
    def of_phrase(phrase: Column) -> Column:
        ws = F.transform(F.regexp_extract_all(phrase, F.lit(WORD), F.lit(0)), fold_word)
        kept = F.transform(ws, lambda w: F.when(~w.isin(stopwords), w))
        # an array of one, so that the words of a phrase are found once and not at each of their uses
        return F.flatten(F.transform(F.array(kept), lambda ks: F.concat(ks, pairs_of(ks))))

    def pairs_of(ks: Column) -> Column:
        return F.zip_with(ks, F.slice(ks, 2, F.greatest(F.size(ks), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))

    phrases = F.split(F.coalesce(text, F.lit("")), PHRASE_END)
    return F.array_compact(F.array_distinct(F.flatten(F.transform(phrases, of_phrase))))


def spanish_date(text: Column) -> Column:
    """``d de mes de yyyy`` to an ISO string, or null."""
    months = "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split()
    pattern = rf"(?iu)(\d{{1,2}})\s+de\s+({'|'.join(months)})\s+de\s+(\d{{4}})"
    day, month, year = (F.regexp_extract(text, pattern, k) for k in (1, 2, 3))
    number = F.array_position(F.array(*map(F.lit, months)), F.lower(month))
    return F.when(day != "", F.concat(year, F.lit("-"), F.lpad(number.cast("string"), 2, "0"), F.lit("-"), F.lpad(day, 2, "0")))


def de_hyphenated(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "­", ""), r"(?U)(\w)-\n(\w)", "$1$2")


def clean_pdf(text: Column) -> Column:
    """Paragraphs of text set in lines: blank lines part them, single line ends are spaces."""
    text = de_hyphenated(F.regexp_replace(text, "\r", ""))
    text = F.regexp_replace(F.regexp_replace(text, r"\n{2,}", "\u0001"), r"\n", " ")
    text = F.regexp_replace(F.regexp_replace(text, "[ \t]+", " "), " ?\u0001 ?", "\n\n")
    return F.trim(text)


TAIL_LABEL = "articulos relacionados"


def tail_at(body: Column, label: str = TAIL_LABEL, least: float = 0.5) -> Column:
    """Characters before the tail that a label opens, or null: the first label, not before the middle of the text; the cut
    is at the line end before it, else at the label, and white space before the cut goes with the tail."""
    at = F.instr(fold_label(body), label)
    before = F.substring(body, F.lit(1), F.greatest(at - 1, F.lit(0)))
    back = F.instr(F.reverse(before), "\n")
    head = F.substring(before, F.lit(1), F.when(back > 0, F.length(before) - back).otherwise(F.length(before)))
    return F.when((at > 0) & (at - 1 >= least * F.length(body)), F.length(F.regexp_replace(head, r"(?U)\s+\z", "")))


def split_tail(body: Column, label: str = TAIL_LABEL) -> Column:
    """struct(head, tail): together the text; tail is null where nothing is cut."""
    at = tail_at(body, label)
    return F.struct(F.when(at.isNull(), body).otherwise(F.substring(body, F.lit(1), at)).alias("head"), F.when(at.isNotNull(), F.substring(body, at + 1, F.length(body))).alias("tail"))
