"""Language labels of sentences, by a native scorer that callers can replace.

The scorer counts words that only one of the two languages uses as function words; the share of the leading
language among them, weakened where there are few, is the confidence. The label policy doesn't depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .status import let

#: Function words of either language that the other doesn't use.
FILIPINO = "ang ng mga sa na ay at si ni kay kina sina nina ito iyon iyan dito doon diyan siya sila kami tayo kayo ako ikaw niya nila namin natin ninyo hindi wala mayroon may kung dahil para pero ngunit subalit kapag nang pa rin din lang lamang po opo ba daw raw naman kaya upang bilang mula hanggang kahit habang".split()
ENGLISH = "the of and to in is was were are be been it that this these those he she they we you his her their our with for from by on as has have had not but or if because when while which who will would can could should there than then into about after before".split()


def scores(text: Column) -> Column:
    """struct<f, e>: how many words of a text are Filipino and English function words. The words are cut once for both."""
    count = lambda words, known: F.size(F.filter(words, lambda w: w.isin(known)))
    return let(F.split(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\W+"), lambda w: F.struct(count(w, FILIPINO).alias("f"), count(w, ENGLISH).alias("e")))


def detect(text: Column, min_confidence: float = 0.0, classify_mixed: bool = True) -> Column:
    """struct<label, confidence>: UNKNOWN for a blank text, OTHER without evidence, MIXED where the evidence is weak."""
    def judged(n: Column) -> Column:
        return _judged(text, n["f"], n["e"], min_confidence, classify_mixed)

    return let(scores(text), judged)


def _judged(text: Column, filipino: Column, english: Column, min_confidence: float, classify_mixed: bool) -> Column:
    most = F.greatest(filipino, english)
    confidence = F.when(most > 0, F.round(most / (filipino + english) * most / (most + 1), 6)).otherwise(0.0)
    label = F.when(most == 0, "OTHER").when(filipino >= english, "FILIPINO").otherwise("ENGLISH")
    weak = F.lit(classify_mixed) & label.isin("FILIPINO", "ENGLISH") & (confidence < min_confidence)
    blank = F.trim(F.coalesce(text, F.lit(""))) == ""
    return F.struct(F.when(blank, "UNKNOWN").when(weak, "MIXED").otherwise(label).alias("label"), F.when(blank, 0.0).otherwise(confidence).alias("confidence"))


def accepted(label: Column, confidence: Column, languages: Column, min_confidence: Column, allow_mixed: Column) -> Column:
    """Whether a labelled sentence is one of the wanted languages; MIXED has no floor where it's allowed."""
    return (F.array_contains(languages, label) & (confidence >= min_confidence)) | (allow_mixed & (label == "MIXED"))
