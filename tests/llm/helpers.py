import zlib


def docs_of(spark, rows, extra=""):
    """documents with (doc_id, text, source) rows."""
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")


def crc_mod(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def space_words(text):
    return [w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w]
