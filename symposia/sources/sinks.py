"""Writing results: JSON, JSON lines in a fixed order, and triples as N-Triples, Turtle, JSON-LD or RDF/XML."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from symposia.rules import vocabulary as V
from symposia.runtime import hot_keys

XSD = "http://www.w3.org/2001/XMLSchema#"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"


def write_json(df: DataFrame, path: str) -> None:
    """Distributed: one file per partition."""
    df.write.mode("overwrite").json(path)


def write_sorted_lines(df: DataFrame, path: str, *keys: str) -> None:
    """JSON lines in a total order over all files (range partitions, named in order)."""
    df.orderBy(*keys).write.mode("overwrite").json(path)


def write_parquet(df: DataFrame, path: str, *by: str) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def predicate_iri(p: Column) -> Column:
    return F.when(p == "type", RDF + "type").when(p == "label", RDFS + "label").when(p.rlike("^[a-z]+://"), p).otherwise(F.concat(F.lit(V.KG), p))


def object_iri(p: Column, o: Column) -> Column:
    """Classes are short names; anything that is no absolute IRI is one of the graph's own names."""
    clean = F.regexp_replace(o, "[\\s<>\"{}|\\\\^`]", "_")
    return F.when(clean.rlike("^([a-z][a-z0-9+.-]*://|urn:)"), clean).otherwise(F.concat(F.lit(V.KG), F.regexp_replace(clean, ":", "_")))


def escaped(c: Column) -> Column:
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def literal(o: Column, datatype: Column, lang: Column) -> Column:
    text = F.concat(F.lit('"'), escaped(o), F.lit('"'))
    return F.when(lang.isNotNull(), F.concat(text, F.lit("@"), lang)).when(datatype.isNull() | (datatype == "string"), text).otherwise(F.concat(text, F.lit("^^<" + XSD), datatype, F.lit(">")))


def n_triples(triples: DataFrame) -> DataFrame:
    """(value) one line per distinct triple: valid N-Triples and valid Turtle."""
    subject = F.concat(F.lit("<"), object_iri(F.lit(""), F.col("s")), F.lit(">"))
    obj = F.when(F.col("o_kind") == "iri", F.concat(F.lit("<"), object_iri(F.col("p"), F.col("o")), F.lit(">"))).otherwise(literal(F.col("o"), F.col("o_datatype"), F.col("o_lang")))
    return triples.distinct().select(F.concat_ws(" ", subject, F.concat(F.lit("<"), predicate_iri(F.col("p")), F.lit(">")), obj, F.lit(".")).alias("value"))


def write_n_triples(triples: DataFrame, path: str) -> None:
    n_triples(triples).write.mode("overwrite").text(path)


#: A subject with more triples than this is written in parts, so that no row grows with a hub.
SUBJECT_ROWS = 10_000


def in_parts(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``_part``: 0, or for keys of very many rows the number of the part a row falls into."""
    hot = hot_keys(rows, [key], SUBJECT_ROWS)
    if hot is None:
        return rows.withColumn("_part", F.lit(0))
    spread = F.xxhash64(*[F.to_json(c) if rows.schema[c].dataType.typeName() == "struct" else F.col(c) for c in rows.columns if c != key])
    return rows.join(F.broadcast(hot), key, "left").withColumn("_part", F.pmod(spread, F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts")


def turtle(triples: DataFrame) -> DataFrame:
    """(value) one Turtle block per subject; a subject of more than SUBJECT_ROWS triples has several, which say the same."""
    lines = n_triples(triples).select(F.split("value", " ", 2).alias("x"))
    parts = in_parts(lines.select(F.col("x")[0].alias("s"), F.regexp_replace(F.col("x")[1], r" \.$", "").alias("po")), "s")
    return parts.groupBy("s", "_part").agg(F.array_join(F.array_sort(F.collect_list("po")), " ;\n    ").alias("body")).select(F.concat(F.col("s"), F.lit(" "), F.col("body"), F.lit(" .\n")).alias("value"))


def json_ld(triples: DataFrame) -> DataFrame:
    """(value) one JSON-LD node object per subject; a subject of more than SUBJECT_ROWS triples has several."""
    iri = F.when(F.col("o_kind") == "iri", object_iri(F.col("p"), F.col("o"))).otherwise(F.col("o"))
    rows = triples.distinct().select(F.col("s"), predicate_iri(F.col("p")).alias("p"), F.struct(iri.alias("o"), "o_kind", "o_datatype", "o_lang").alias("v"))
    grouped = in_parts(rows, "s").groupBy("s", "_part").agg(F.array_sort(F.collect_list(F.struct("p", "v"))).alias("ps"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for s, ps in zip(pdf["s"], pdf["ps"], strict=True):
                node: dict = {"@id": s}
                for x in ps:
                    p, v = x["p"], x["v"]
                    if p == RDF + "type":
                        node.setdefault("@type", []).append(v["o"])
                    elif v["o_kind"] == "iri":
                        node.setdefault(p, []).append({"@id": v["o"]})
                    elif v["o_lang"]:
                        node.setdefault(p, []).append({"@value": v["o"], "@language": v["o_lang"]})
                    else:
                        node.setdefault(p, []).append({"@value": v["o"], "@type": XSD + (v["o_datatype"] or "string")})
                out.append(json.dumps(node, ensure_ascii=False))
            yield pd.DataFrame({"value": out})

    return grouped.mapInPandas(run, "value string")


def rdf_xml(triples: DataFrame) -> DataFrame:
    """(value) one ``rdf:Description`` element per triple; put between the header and footer of ``XML_FRAME``."""
    esc = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    name = F.regexp_replace(F.col("p"), "[^A-Za-z0-9_]", "_")
    obj = F.when(F.col("o_kind") == "iri", F.concat(F.lit('<k:'), name, F.lit(' rdf:resource="'), esc(object_iri(F.col("p"), F.col("o"))), F.lit('"/>'))).otherwise(
        F.concat(F.lit("<k:"), name, F.when(F.col("o_lang").isNotNull(), F.concat(F.lit(' xml:lang="'), F.col("o_lang"), F.lit('"'))).otherwise(F.concat(F.lit(' rdf:datatype="' + XSD), F.coalesce("o_datatype", F.lit("string")), F.lit('"'))), F.lit(">"), esc(F.col("o")), F.lit("</k:"), name, F.lit(">"))
    )
    return triples.distinct().select(F.concat(F.lit('<rdf:Description rdf:about="'), esc(object_iri(F.lit(""), F.col("s"))), F.lit('">'), obj, F.lit("</rdf:Description>")).alias("value"))


XML_FRAME = (f'<?xml version="1.0"?>\n<rdf:RDF xmlns:rdf="{RDF}" xmlns:k="{V.KG}">', "</rdf:RDF>")


def rdf_xml_document(triples: DataFrame, path: str) -> None:
    """RDF/XML, every file of it whole: elements between the frame's two parts."""
    head, foot = XML_FRAME

    def framed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": [head]})
        for pdf in frames:
            yield pdf
        yield pd.DataFrame({"value": [foot]})

    rdf_xml(triples).mapInPandas(framed, "value string").write.mode("overwrite").text(path)


def annotations(entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(section, record_id, entities, relations): the nested view of flat rows keyed by section and record."""
    e = entities.groupBy("section", "record_id").agg(F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in entities.columns if c not in ("section", "record_id")]))).alias("entities"))
    r = relations.groupBy("section", "record_id").agg(F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in relations.columns if c not in ("section", "record_id")]))).alias("relations"))
    return e.join(r, ["section", "record_id"], "full")
