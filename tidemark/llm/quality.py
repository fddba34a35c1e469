"""Quality rules, line first: judge every line, remove the failures, then reject documents that lost too much.

Only DataFrame functions are used. Each expression that a lambda reads stands in a projection of its own, so that
it is computed once a row and not once an element.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, WORD_CLASS

#: Lower-case phrases, by language, that mark a line as navigation or boilerplate of a web page.
BOILERPLATE = {
    "en": ("accept all cookies", "add to cart", "all rights reserved", "back to top", "click here", "cookie policy", "enable javascript", "forgot your password", "log in to", "lorem ipsum", "privacy policy", "read more", "share on facebook", "sign up for", "skip to content", "subscribe to our", "terms of service", "terms of use", "use of cookies"),
    "fr": ("accepter tous les cookies", "ajouter au panier", "aller au contenu", "cliquez ici", "conditions d'utilisation", "en savoir plus", "inscrivez-vous", "lire la suite", "mentions légales", "mot de passe oublié", "politique de confidentialité", "retour en haut", "tous droits réservés"),
    "de": ("alle cookies akzeptieren", "alle rechte vorbehalten", "cookie-richtlinie", "datenschutzerklärung", "in den warenkorb", "jetzt anmelden", "klicken sie hier", "mehr erfahren", "nach oben", "nutzungsbedingungen", "passwort vergessen", "weiterlesen", "zum inhalt springen"),
    "es": ("aceptar todas las cookies", "añadir al carrito", "aviso legal", "haga clic aquí", "iniciar sesión", "ir al contenido", "leer más", "olvidó su contraseña", "política de cookies", "política de privacidad", "términos de uso", "todos los derechos reservados", "volver arriba"),
}
#: A phrase stands between characters that are no letters.
PHRASES = r"(?:^|[^\p{L}])(?:" + "|".join(x for own in BOILERPLATE.values() for x in own) + r")(?:[^\p{L}]|$)"
#: Marks that close a line, after which quotes and brackets may stand; and letters of scripts that use them.
CLOSED = r"""[.!?:;…。！？]["'”’»›)\]]*""" + f"{SPACE_CLASS}*\\z"
LETTERS = "[A-Za-zÀ-ɏͰ-ϿЀ-ӿ]"
#: Fixed by the task.
SYMBOLS = r"#*$%&|<>"


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the line rules and of the verdict.

    A line with words fails if it has more symbols than ``symbol_share`` of its words, more than ``separators``
    bars, arrows or bullets between words, more than ``shouts`` doubled exclamation marks, no closing mark after at most
    ``open_words`` words in a script that has such marks, a boilerplate phrase in at most ``phrase_words`` words, or one
    word ``repeat_words`` times in a row.
    """

    symbol_share: float = 0.3
    separators: int = 3
    shouts: int = 4
    open_words: int = 12
    phrase_words: int = 25
    repeat_words: int = 10
    lost_share: float = 0.5
    min_words: int = 50
    repeat_share: int = 50


def _count(text: Column, keep_out: str) -> Column:
    """Characters that are left when every run matching ``keep_out`` is taken away."""
    return F.length(F.regexp_replace(text, keep_out, ""))


def count_words(text: Column) -> Column:
    return F.size(F.filter(F.split(text, f"{SPACE_CLASS}+"), lambda w: w != ""))


def line_fails(line: Column, n_words: Column, rules: LineRules) -> Column:
    """Whether a line of ``n_words`` words breaks a rule; a line without words never does."""
    symbols = _count(line, rf"[^{SYMBOLS}]+")
    bars = _count(line, "[^|»›•·→]+")
    shouts = F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("!")))
    is_open = (n_words <= rules.open_words) & ~line.rlike(CLOSED) & line.rlike(LETTERS)
    phrase = (n_words <= rules.phrase_words) & F.lower(line).rlike(PHRASES)
    one_word = (n_words >= rules.repeat_words) & line.rlike(rf"(?:^|{SPACE_CLASS})({WORD_CLASS}+)(?:{SPACE_CLASS}+\1){{{rules.repeat_words - 1}}}(?:{SPACE_CLASS}|$)")
    return (n_words > 0) & ((symbols > rules.symbol_share * n_words) | (bars > rules.separators) | (shouts > rules.shouts) | is_open | phrase | one_word)


def counted_lines(lines: Column) -> Column:
    """Each line with its number of words, so that no rule has to count them again."""
    return F.transform(lines, lambda line: F.struct(line.alias("line"), count_words(line).alias("n")))


def kept_lines(counted: Column, rules: LineRules) -> Column:
    """Of the lines from ``counted_lines``, those that keep all line rules."""
    return F.filter(counted, lambda x: ~line_fails(x["line"], x["n"], rules))


def quality_table(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: LineRules | None = None) -> DataFrame:
    """One row per document with counts, the base verdict, the words left after the line rules, and ``kept``.

    A null or empty text has no words and fails the base; repeated rows give repeated results; an empty table gives an
    empty one; other columns are not read. Windows of three words are compared by a chained 64-bit hash within one text.
    """
    rules = rules or LineRules()
    source = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    split = source.select(
        "doc_id", "t",
        F.filter(F.split("t", f"{SPACE_CLASS}+"), lambda w: w != "").alias("w"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD_CLASS)).alias("lines"),
    )
    hashed = split.select(
        "doc_id", "t", "lines",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.transform(F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))).alias("b"), F.slice("w", 3, F.greatest(F.size("w") - 2, F.lit(0))).alias("c")), lambda z: F.xxhash64(z["a"], F.lit(" "), z["b"], F.lit(" "), z["c"])).alias("all_h"),
    )
    placed = hashed.select(
        "doc_id", "t", "lines", "n_words", "word_chars",
        F.array_sort(F.transform(F.slice("all_h", 1, F.greatest(F.col("n_words").cast("int") - 2, F.lit(0))), lambda h, i: F.struct(h.alias("h"), i.alias("i")))).alias("s"),
    )
    again = placed.select(
        "doc_id", "t", "lines", "n_words", "word_chars",
        F.transform(F.filter(F.arrays_zip(F.col("s").alias("x"), F.slice("s", 2, F.greatest(F.size("s") - 1, F.lit(0))).alias("y")), lambda z: z["x"]["h"] == z["y"]["h"]), lambda z: F.array(z["x"]["i"], z["y"]["i"])).alias("pairs"),
    )
    covered = again.select(
        "doc_id", "t", "lines", "n_words", "word_chars",
        F.size(F.array_distinct(F.flatten(F.transform(F.array_distinct(F.flatten("pairs")), lambda i: F.array(i, i + 1, i + 2))))).cast("long").alias("n_repeat_words"),
    )
    counted = covered.select(
        "doc_id", "n_words", "word_chars", "n_repeat_words",
        _count(F.col("t"), rf"[^{SYMBOLS}]+").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        counted_lines(F.col("lines")).alias("counted"),
    )
    judged = counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.aggregate(kept_lines(F.col("counted"), rules), F.lit(0).cast("long"), lambda total, x: total + x["n"]).alias("n_clean_words"),
        ((F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.repeat_share * F.col("n_words"))).alias("base_failed"),
    )
    lost = F.col("n_words") - F.col("n_clean_words") > F.lit(rules.lost_share) * F.col("n_words")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~lost).alias("kept"), "n_clean_words")


def clean_text(text: Column, rules: LineRules | None = None) -> Column:
    """A text without the lines that break a rule; lines without words stay, a null stays null."""
    return F.array_join(F.transform(kept_lines(counted_lines(F.split(text, "\n")), rules or LineRules()), lambda x: x["line"]), "\n")
