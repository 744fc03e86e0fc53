"""Stop-word lists.

The base lists are MLlib's defaults (the files ``StopWordsRemover.
loadDefaultStopWords`` reads), kept unchanged as package data in
``stopwords_data/`` so they are available without a JVM or Spark's jars
(e.g. to write oracle SQL).
"""

from __future__ import annotations

import os
import unicodedata
from functools import lru_cache

# Fixed values (this tuple and the three below): negations kept by the text
# model, and the extra words of the text model, the notebook and the cloud.
KEEP_NEGATIONS = ("no", "nunca", "ni")
TEXT_MODEL_EXTRAS = (
    "dijo", "comento", "menciono", "indico", "pidio", "mostro", "solicito", "confirmo",
    "expreso", "expresó",
    "que", "de", "del", "la", "el", "al", "por", "para", "en", "con", "se", "su", "ya", "solo", "le",
    "cliente", "asesor", "gestion", "llamada", "contacto", "informacion", "detalle", "detalles",
    "opcion", "opciones",
    "paquete", "variante", "variantes", "producto", "productos", "hogar", "movilidad", "conectividad",
    "propuesta", "oferta", "compra", "comprar", "adquirir", "reservar", "precio", "precios",
    "servicio", "servicios", "utiliza", "necesita", "necesario",
    "cuando", "como", "mas", "más", "tambien", "también", "proximo", "proxima", "próximo", "próxima",
    "nuevamente", "probablemente", "estuvo", "estaba", "cuenta", "aclaro", "aclaró", "similar",
    "tiene", "decia", "decía", "podria", "podría",
)
NOTEBOOK_EXTRAS = (
    "dijo", "comento", "comentó", "menciono", "mencionó", "indico", "indicó",
    "pidio", "pidió", "mostro", "mostró", "solicito", "solicitó",
    "que", "de", "del", "la", "el", "al", "por", "para",
    "cliente", "asesor", "gestion", "gestión", "llamada", "contacto",
    "servicio", "servicios", "opciones", "opcion", "presupuesto",
    "producto", "productos", "paquete", "cuenta", "compra",
    "solucion", "detalles", "detalle", "informacion", "información",
    "más", "mas", "solo", "tambien", "también",
)
CLOUD_EXTRAS = (
    "cliente", "llamada", "whatsapp", "asesor", "gestion", "gestiones",
    "producto", "productos", "servicio", "servicios", "oferta",
    "paquete", "informacion", "información", "mas", "más",
    "dijo", "comentó", "comento", "menciono", "mencionó",
    "indico", "indicó", "pidio", "pidió", "mostro", "mostró",
    "que", "de", "la", "el", "los", "las", "en", "por", "para",
    "interes", "interesado", "interesada", "interesados",
    "interesarse", "interesar",
)


@lru_cache(maxsize=None)
def default_stopwords(language: str = "spanish") -> tuple[str, ...]:
    """MLlib's default list for ``language``, in file order."""
    path = os.path.join(os.path.dirname(__file__), "stopwords_data", f"{language}.txt")
    with open(path, encoding="utf-8") as f:
        raw = f.read()
    return tuple(w for w in raw.split("\n") if w)


@lru_cache(maxsize=None)
def text_model_stopwords() -> tuple[str, ...]:
    """Spanish defaults without the negations, plus the extras; trimmed,
    de-duplicated, sorted."""
    base = [w for w in default_stopwords("spanish") if w not in KEEP_NEGATIONS]
    return tuple(sorted({w.strip() for w in (*base, *TEXT_MODEL_EXTRAS)}))


@lru_cache(maxsize=None)
def notebook_stopwords() -> tuple[str, ...]:
    base = [w for w in default_stopwords("spanish") if w not in KEEP_NEGATIONS]
    return tuple(sorted(set(base) | set(NOTEBOOK_EXTRAS)))


@lru_cache(maxsize=None)
def cloud_stopwords() -> tuple[str, ...]:
    """English base list (the word-cloud library's own list is not part of
    the studied code; MLlib's English list stands in) plus the app's extras."""
    return tuple(sorted(set(default_stopwords("english")) | set(CLOUD_EXTRAS)))


def fold_accents(word: str) -> str:
    """The word without combining marks (NFD), as ``text.strip_accents`` gives it."""
    return "".join(c for c in unicodedata.normalize("NFD", word) if unicodedata.category(c) != "Mn")


def folded(words) -> tuple[str, ...]:
    """Words without accents, de-duplicated and sorted."""
    return tuple(sorted({fold_accents(w) for w in words}))


def accent_variants(words) -> tuple[str, ...]:
    """Every folded word, with no accent or with one accented letter: for matchers
    that compare words as they stand (``StopWordsRemover``)."""
    marks = dict(zip("aeioun", "áéíóúñ"))
    out = set(words)
    for w in folded(words):
        out.add(w)
        out.update(w[:i] + marks[c] + w[i + 1:] for i, c in enumerate(w) if c in marks)
        out.update(w[:i] + "ü" + w[i + 1:] for i, c in enumerate(w) if c == "u")
    return tuple(sorted(out))


def sql_list(words) -> str:
    """Words as a SQL list literal."""
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"
