"""The whole run: tables in, graph, inference, metrics, shape report and triples out. Command: ``python -m symposia.plans.build``."""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia import config as settings
from symposia.operators import entities, graph as graph_operators, metrics, ontology, predicates, reasoning, resolve, segments, structure, triples
from symposia.runtime import cut, ship
from symposia.sources import sinks

VERSION = "0.2"


def build(spark: SparkSession, base: str, config: settings.EngineConfig) -> dict[str, DataFrame]:
    """Every result of a run as a plan; nothing is written. Ends of relations are led to the entities that stand for them."""
    canonical = cut(resolve.canonical_entities(spark, base, config.fuzzy_threshold))
    merged = canonical.where("rule = 'merged'").select(F.col("uri").alias("old"), F.col("canonical").alias("new"))
    relations = predicates.precise_relations(spark, base)
    if config.consolidate:
        relations = entities.rewrite(relations, cut(merged)).drop("moved")
    relations = cut(ontology.registered_only(cut(relations), config.strict_predicates))
    none = "source string, relation string, target string, confidence double, rule string, rule_id string, iteration int"
    inferred = cut(reasoning.inferred_relations(spark, base, config.least_confidence, config.inference_rounds)) if config.reasoning else spark.createDataFrame([], none)
    graph = cut(triples.with_closure(triples.graph_triples(spark, base, relations, inferred).unionByName(triples.field_assertions(spark, base))))
    by_record = entities.mentions(spark, base).select(F.substring_index("origin_key", "|", 1).alias("section"), F.substring_index("origin_key", "|", -1).alias("record_id"), "uri", "label", "confidence").distinct()
    told = relations.select(F.lower(F.coalesce("section", F.lit("unknown"))).alias("section"), F.col("doc_id").alias("record_id"), "source", "relation", "target", "confidence")
    log = entities.decision_log(spark, base)
    return {
        "entities": resolve.registry(spark, base),
        "canonical": canonical,
        "merged": entities.merge(cut(resolve.registry(spark, base)), canonical.select("uri", "canonical")),
        "alias_map": entities.alias_map(spark, base),
        "decision_log": log,
        "structure": structure.structural_edges(spark, base, config.kg_base),
        "relations": relations,
        "inferred": inferred,
        "conflicts": predicates.conflicts(relations.select("source", "relation", "target").unionByName(inferred.select("source", "relation", "target"))),
        "provenance": segments.provenance_gate(spark, base),
        "provenance_breakdown": entities.provenance_breakdown(spark, base),
        "annotations": sinks.annotations(by_record, told),
        "analytics": graph_operators.analytics_summary(spark, base),
        "metrics": metrics.quality_metrics(spark, base),
        "schema": ontology.onto_triples(spark, base),
        "shapes": triples.check_shapes(graph, held=True),
        "triples": graph,
        "run": spark.createDataFrame([(config.dataset_id, config.run_id, VERSION, "reasoned" if config.reasoning else "asserted")], "dataset_id string, run_id string, version string, mode string"),
    }


def write(results: dict[str, DataFrame], target: str, config: settings.EngineConfig) -> None:
    """Tables, the graph in the format asked for, aliases and log as lines in order; the gates of a run come first."""
    segments.enforce_gate(results["provenance"], 0.0 if config.strict_provenance else config.most_unknown)
    if config.fail_on_shapes:
        triples.enforce_shapes(results["shapes"])
    for name, df in results.items():
        (sinks.write_json if config.output_format == "json" else sinks.write_parquet)(df, f"{target}/{name}")
    sinks.write_sorted_lines(results["alias_map"], f"{target}/alias_map.jsonl", "normalised", "raw", "uri")
    sinks.write_sorted_lines(results["decision_log"], f"{target}/decision_log.jsonl", "uri", "rule", "source_ids")
    path = f"{target}/graph.{config.triple_format}"
    if config.triple_format == "nt":
        sinks.write_n_triples(results["triples"], path)
    elif config.triple_format == "xml":
        sinks.rdf_xml_document(results["triples"], path)
    else:
        (sinks.turtle if config.triple_format == "ttl" else sinks.json_ld)(results["triples"]).write.mode("overwrite").text(path)


def main() -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--config")
    p.add_argument("--run-id", help="name of the run; it is never made from the clock")
    p.add_argument("--format", choices=("nt", "ttl", "jsonld", "xml"))
    p.add_argument("--no-reasoning", action="store_true")
    p.add_argument("--no-consolidation", action="store_true")
    p.add_argument("--strict", action="store_true", help="no ungrounded mention, no unregistered predicate, no violated shape")
    a = p.parse_args()
    changes: dict = {"reasoning": False} if a.no_reasoning else {}
    changes |= {"consolidate": False} if a.no_consolidation else {}
    changes |= {"run_id": a.run_id} if a.run_id else {}
    changes |= {"triple_format": a.format} if a.format else {}
    changes |= {"strict_provenance": True, "strict_predicates": True, "fail_on_shapes": True} if a.strict else {}
    config = replace(settings.load(a.config), **changes)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship(spark)
    write(build(spark, a.input, config), a.output, config)


if __name__ == "__main__":
    main()
