"""The graph as triples (s, p, o, o_kind, o_datatype, o_lang), and the operators on it.

Triples are a set: writers and checks read the distinct rows. Predicates and classes are short names of the graph's
namespace; ``sinks`` writes them out as IRIs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from symposia.functions import columns as C
from symposia.operators.entities import _LOCAL, _RSPANS, _S, _UNIT, MENTIONS, discourse_units, evidence_nodes, mention_edges
from symposia.operators.ontology import superclasses
from symposia.operators.predicates import BASE, PRECISE, precise_relations
from symposia.operators.reasoning import _RULE_ID, _fixpoint_sql, inference_stats, inferred_numbers, inferred_relations, named, numbered
from symposia.operators.resolve import _REG, registry
from symposia.operators.rounds import BESIDE, CODE, NAMED, NAMES, RULES, TALLY, by_ends, hashed, hashed_and_tallied, labelled, tallied, tally, told_apart
from symposia.operators.segments import _TEXTS
from symposia.operators.structure import BUCKET, EDGES, LATEST, latest_votes, node, structural_edges
from symposia.rules import vocabulary as V
from symposia.runtime import PACKED, cut, freed, located, packed, read, repeats, tasks

COLUMNS = ["s", "p", "o", "o_kind", "o_datatype", "o_lang"]


def triple(p: str | Column, o: Column, kind: str = "literal", datatype: str | None = "string", lang: str | None = None) -> Column:
    name = F.lit(p) if isinstance(p, str) else p
    return F.struct(name.alias("p"), o.cast("string").alias("o"), F.lit(kind).alias("o_kind"), F.lit(None if kind == "iri" else datatype).cast("string").alias("o_datatype"), F.lit(lang).cast("string").alias("o_lang"))


def unfold(rows: DataFrame, subject: Column, parts: list[Column]) -> DataFrame:
    """One row per part with an object; a single generator over each input row, no union of scans."""
    return rows.select(subject.alias("s"), F.explode(F.array(*parts)).alias("t")).select("s", "t.*").where("s is not null and o is not null")


def raw_field_triples(spark: SparkSession, base: str) -> DataFrame:
    """Fields of the records as typed literals."""
    name = lambda c: C.blank_to_null(F.col(c))
    date = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    specs = {
        "themes": ("Theme", [("name", name("name"), "string"), ("description", name("description"), "string"), ("domainCategory", name("domain_category"), "string"), ("problemCategory", name("problem_category"), "string"), ("modelCategory", name("model_category"), "string"), ("views", F.col("views"), "integer"), ("createdAt", date("created_at"), "dateTime")]),
        "questions": ("Question", [("title", name("title"), "string"), ("body", name("body"), "string"), ("views", F.col("views"), "integer"), ("createdAt", date("created_at"), "dateTime")]),
        "answers": ("Answer", [("text", name("body"), "string"), ("createdAt", date("created_at"), "dateTime")]),
        "experts": ("Expert", [("displayName", name("display_name"), "string"), ("areaOfExpertise", name("area_of_expertise"), "string"), ("bio", name("bio"), "string"), ("isDeleted", F.col("is_deleted"), "boolean"), ("dateJoined", date("date_joined"), "dateTime")]),
    }
    specs["documents"] = ("Document", [("title", name("title"), "string"), ("language", name("lang"), "string"), ("url", name("url"), "string"), ("createdAt", date("created_at"), "dateTime")])
    out = None
    for table, (kind, fields) in specs.items():
        parts = [triple("type", F.lit(kind), "iri"), *[triple(p, v, "literal", t) for p, v, t in fields]]
        rows = unfold(read(spark, base, table), node(kind.lower(), F.col("doc_id" if table == "documents" else "id")), parts)
        out = rows if out is None else out.unionByName(rows)
    return out


def field_assertions(spark: SparkSession, base: str) -> DataFrame:
    """Provenance of each raw field: a node per (record, field) with what was asserted."""
    rows = raw_field_triples(spark, base).where("p <> 'type'")
    key = F.concat(F.lit(f"{V.KG}assert_"), C.short_hash(F.concat_ws("|", "s", "p")))
    tail = F.substring_index("s", "#", -1)
    parts = [triple("type", F.lit("FieldAssertion"), "iri"), triple("fieldName", F.col("p")), triple("recordId", F.substring_index(tail, "_", -1)), triple("sourceSection", F.substring_index(tail, "_", 1)), triple("assertedPredicate", F.concat(F.lit(V.KG), F.col("p")), "iri"), triple("assertedValue", F.col("o")), triple("wasDerivedFrom", F.col("s"), "iri")]
    return unfold(rows, key, parts)


def entity_triples(spark: SparkSession, base: str) -> DataFrame:
    rows = registry(spark, base)
    parts = [triple("type", F.col("entity_type"), "iri"), triple("label", C.blank_to_null(F.col("label")), "literal", "langString", "en"), triple("confidence", F.col("confidence"), "literal", "float"), triple("ontology_uri", F.col("ontology_uri"), "iri")]
    return unfold(rows, F.col("uri"), parts)


def vote_triples(spark: SparkSession, base: str) -> DataFrame:
    """Votes as nodes: by whom, for what, the value typed, its concept and its polarity; one expert and one answer each."""
    rows = latest_votes(spark, base).where("expert is not null and coalesce(answer_id, 0) <> 0")
    bucket = C.vote_bucket(F.col("value"))
    concept = F.when(bucket == "endorses", "Positive").when(bucket == "disagreesWith", "Negative").when(bucket == "isNeutralOn", "Neutral")
    polarity = F.when(bucket == "endorses", "positive").when(bucket == "disagreesWith", "negative").otherwise("neutral")
    parts = [triple("type", F.lit("Vote"), "iri"), triple("rawValue", F.col("value")), triple("rawVoteValue", F.col("value").try_cast("bigint"), "literal", "integer"), triple("voteValue", F.coalesce(C.rating_concept(F.when(bucket == "interactsWith", F.col("value"))), concept), "iri"), triple("polarity", polarity), triple("castAt", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), "literal", "dateTime")]
    return unfold(rows, node("vote", F.col("vote_key")), parts)


def cast_by(edges: DataFrame) -> DataFrame:
    """(source, target, confidence) of exactly one ``castBy`` a vote: of all said of it, and of ``castVote`` the other way round,
    the most confident, then the least expert."""
    said = edges.where("predicate = 'castBy'").select("source", "target", "confidence").unionByName(edges.where("predicate = 'castVote'").select(F.col("target").alias("source"), F.col("source").alias("target"), "confidence"))
    return said.groupBy("source").agg(F.min(F.struct((-F.col("confidence")).alias("c"), "target")).alias("b")).select("source", F.col("b.target").alias("target"), (-F.col("b.c")).alias("confidence"))


def structure_triples(spark: SparkSession, base: str) -> DataFrame:
    """The backbone as statements, every vote with one expert; discourse units and what they mention."""
    edges = structural_edges(spark, base)
    direct = edges.where("predicate <> 'castBy'").select("source", "predicate", "target").unionByName(cast_by(edges).select("source", F.lit("castBy").alias("predicate"), "target"))
    told = mention_edges(spark, base).select("source", F.lit("mentions").alias("predicate"), "target")
    units = unfold(discourse_units(spark, base), F.col("uri"), [triple("type", F.lit("DiscourseUnit"), "iri"), triple("originKey", F.col("origin_key")), triple("nChars", F.col("n_chars"), "literal", "integer")])
    return unfold(direct.unionByName(told), F.col("source"), [triple(F.col("predicate"), F.col("target"), "iri")]).unionByName(units)


def relation_triples(spark: SparkSession, base: str, relations: DataFrame | None = None, inferred: DataFrame | None = None, asserted: bool = True) -> DataFrame:
    """Asserted and inferred relations, or the latter only: the direct statement, the relation as a node, its evidence."""
    rows = precise_relations(spark, base) if relations is None else relations
    made = inferred_relations(spark, base) if inferred is None else inferred
    key = C.short_hash(F.concat_ws("|", "source", "relation", "target"))
    none = lambda t: F.lit(None).cast(t)
    drawn = made.select(
        F.concat(F.lit(f"{V.KG}inferred_"), key).alias("rel"), "source", "relation", "target", "confidence", F.lit(True).alias("is_inferred"), "rule_id", F.concat(F.lit(f"{V.KG}evidence_"), C.short_hash(F.concat(key, F.lit("|0")))).alias("evidence"),
        F.concat_ws(" ", C.local_name(F.col("source")), "relation", C.local_name(F.col("target"))).alias("text"), none("bigint").alias("discourse_id"), none("int").alias("chunk_index"), none("bigint").alias("start_char"), none("bigint").alias("end_char"), F.lit("reasoner").alias("by"),
    )
    if asserted:
        proof = evidence_nodes(spark, base).select("uri", "evidence", "text", "discourse_id", F.when(F.col("chunk_index") >= 0, F.col("chunk_index")).alias("chunk_index"), "start_char", "end_char")
        told = rows.join(proof, "uri", "left").select(F.concat(F.lit(V.KG), F.col("uri")).alias("rel"), "source", "relation", "target", "confidence", "is_inferred", F.lit(None).cast("string").alias("rule_id"), "evidence", "text", "discourse_id", "chunk_index", "start_char", "end_char", F.coalesce("extractor", F.lit("unknown")).alias("by"))
        drawn = told.unionByName(drawn)
    rows = drawn
    reified = unfold(rows, F.col("rel"), [triple("type", F.lit("Relation"), "iri"), triple("subject", F.col("source"), "iri"), triple("predicate", F.concat(F.lit(V.KG), F.col("relation")), "iri"), triple("object", F.col("target"), "iri"), triple("confidence", F.col("confidence"), "literal", "float"), triple("isInferred", F.col("is_inferred"), "literal", "boolean"), triple("inferenceRule", F.col("rule_id")), triple("hasEvidence", F.col("evidence"), "iri")])
    direct = unfold(rows, F.col("source"), [triple(F.col("relation"), F.col("target"), "iri")])
    nodes = unfold(rows, F.col("evidence"), [triple("type", F.lit("Evidence"), "iri"), triple("evidenceText", F.col("text")), triple("confidence", F.col("confidence"), "literal", "float"), triple("discourse_id", F.col("discourse_id"), "literal", "integer"), triple("chunk_index", F.col("chunk_index"), "literal", "integer"), triple("start_char", F.col("start_char"), "literal", "integer"), triple("end_char", F.col("end_char"), "literal", "integer"), triple("source", F.col("by"))])
    return direct.unionByName(reified).unionByName(nodes)


def graph_triples(spark: SparkSession, base: str, relations: DataFrame | None = None, inferred: DataFrame | None = None) -> DataFrame:
    """The whole graph: fields of records, votes, backbone, units and mentions, entities, asserted and inferred relations."""
    parts = [raw_field_triples(spark, base), vote_triples(spark, base), structure_triples(spark, base), entity_triples(spark, base), relation_triples(spark, base, relations, inferred)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.distinct()


#: Predicates of the node of an inferred relation and of its evidence, with the kind of their objects: one triple each.
_DRAWN = {"relation": (("type", "iri"), ("subject", "iri"), ("predicate", "iri"), ("object", "iri"), ("confidence", "literal"), ("isInferred", "literal"), ("inferenceRule", "literal"), ("hasEvidence", "iri")), "evidence": (("type", "iri"), ("evidenceText", "literal"), ("confidence", "literal"), ("source", "literal"))}


class Parts:
    """The graph without what was inferred, and the inferred relations beside it: they are many times the rest, and each has a
    node, an evidence node and one statement of its own, so that they can be counted and labelled without being laid out.

    That holds while their names, which are hashes, are given once in the whole graph: ``apart`` finds out. ``of`` is what a
    reader needs of the rest; nodes of inferred relations stay numbers (``ids``) until their names are asked for."""

    def __init__(self, spark: SparkSession, base: str, of: str = "true") -> None:
        none = spark.createDataFrame([], "source string, relation string, target string, confidence double, rule string, rule_id string, iteration int")
        self.told = cut(graph_triples(spark, base, None, none).where(of))
        freed(spark)
        self.made = inferred_numbers(spark, base)
        self.ids = self.made.ids
        self.counted = None

    def apart(self, evidence: bool = True) -> bool:
        """Whether no relation's name, nor that of its ``evidence``, is given twice."""
        return not repeats(self._taken(evidence).unionByName(self.made.read(hashed(located(self.ids), evidence), PACKED)))

    def _taken(self, evidence: bool) -> DataFrame:
        given = F.regexp_extract("s", f"^{re.escape(V.KG)}{'(?:inferred|evidence)' if evidence else 'inferred'}_([0-9a-f]{{16}})$", 1)
        return packed(self.told.select("s").distinct().select(given.alias("x")).where("x <> ''").select(F.unhex("x")))

    def _same(self) -> DataFrame:
        same = self.told.where((F.col("o_kind") == "iri") & F.col("p").isin(*NAMES)).select("s", "p", "o").distinct()
        code = F.create_map(*[F.lit(x) for kv in CODE.items() for x in kv])
        return cut(numbered(same, self.ids).select(F.element_at(code, F.col("p")).alias("p"), "s", "o"))

    def apart_and_tallied(self) -> bool:
        """``apart``; relations are counted (``tallied``) while they are made for it."""
        spark = self.told.sparkSession
        made = self.made.read(hashed_and_tallied(located(self.ids), located(self._same())), BESIDE)
        rows = made.unionByName(self._taken(True), allowMissingColumns=True).repartition(tasks(spark), "bucket")
        self.counted = cut(rows.mapInArrow(tallied, TALLY))
        return not self.counted.where("p = -2").limit(1).count()

    def tallied(self) -> DataFrame:
        if self.counted is None:
            self.counted = cut(self.made.read(tally(located(self.ids), located(self._same())), TALLY))
        return self.counted

    def statements(self) -> DataFrame:
        """(p, id, n, fresh): the inferred statements by predicate and subject's number, and how many of them the rest does not make."""
        rows = self.tallied().where("p >= 0").groupBy("p", "id").agg(F.sum("n").alias("n"), F.sum(F.col("n") - F.col("same")).alias("fresh"))
        return rows.withColumn("p", F.get(F.array(*[F.lit(x) for x in NAMES]), F.col("p")))

    def node_counts(self) -> DataFrame:
        """(p, o_kind, n): triples of the nodes of inferred relations and of their evidence."""
        pairs = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(kind).alias("o_kind")) for part in _DRAWN.values() for p, kind in part])
        total = self.statements().agg(F.sum("n").alias("n")).where("n > 0")
        return total.select("n", F.explode(pairs).alias("x")).groupBy("x.p", "x.o_kind").agg(F.sum("n").alias("n"))

    def ends(self) -> DataFrame:
        """(s): sources and targets of inferred relations that no relation of the rest names."""
        used = self.told.where("p in ('subject', 'object') and o_kind = 'iri'").select(F.col("o").alias("name")).distinct()
        loose = cut(self.ids.join(used, "name", "left_anti"))
        if not loose.limit(1).count():
            return loose.select(F.col("name").alias("s"))
        return cut(loose.join(self.tallied(), "id", "left_semi").select(F.col("name").alias("s")))


def flat_relations(spark: SparkSession, base: str) -> DataFrame:
    """(section, predicate, n): every statement between nodes by where it comes from."""
    told = precise_relations(spark, base).select(F.lit("asserted").alias("section"), F.col("relation").alias("predicate"))
    drawn = inference_stats(spark, base).groupBy(F.lit("inferred").alias("section"), F.col("relation").alias("predicate")).agg(F.sum("n").alias("n"))
    edges = structural_edges(spark, base).select(F.lit("structure").alias("section"), "predicate")
    named = mention_edges(spark, base).select(F.lit("mentions").alias("section"), F.lit("mentions").alias("predicate"))
    return told.unionByName(edges).unionByName(named).groupBy("section", "predicate").agg(F.count(F.lit(1)).alias("n")).unionByName(drawn)


def with_closure(triples: DataFrame) -> DataFrame:
    """A type for every object of a relation that has no triple of its own."""
    triples = cut(triples)
    ends = triples.where("p in ('subject', 'object') and o_kind = 'iri'").select(F.col("o").alias("s")).distinct()
    bare = cut(ends.join(triples.select("s").distinct(), "s", "left_anti"))
    return triples.unionByName(unfold(bare, F.col("s"), [triple("type", F.lit("Entity"), "iri")]))


_STRUCTURAL = ("Theme", "Question", "Answer", "Expert", "Relation", "Evidence", "FieldAssertion", "Vote", "Document", "DiscourseUnit")


def lone_entities(triples: DataFrame, ends: DataFrame | None = None, kinds: tuple[str, ...] = _STRUCTURAL) -> DataFrame:
    """(s) of entities that no relation names, ``ends`` being named as well."""
    used = triples.where("p in ('subject', 'object') and o_kind = 'iri'").select(F.col("o").alias("s"))
    used = (used if ends is None else used.unionByName(ends)).distinct()
    structural = triples.where((F.col("p") == "type") & F.col("o").isin(*kinds)).select("s").distinct()
    return triples.where("p = 'type'").select("s").distinct().join(used, "s", "left_anti").join(structural, "s", "left_anti")


def without(triples: DataFrame, lone: DataFrame) -> DataFrame:
    return triples.join(lone, "s", "left_anti").join(lone.select(F.col("s").alias("o")), "o", "left_anti").select(*COLUMNS)


def pruned(triples: DataFrame, kinds: tuple[str, ...] = _STRUCTURAL) -> DataFrame:
    """Without entities that no relation names, and without every triple that touches them."""
    triples = cut(triples)
    return without(triples, lone_entities(triples, None, kinds))


def isolated_entities(spark: SparkSession, base: str) -> DataFrame:
    """Entities that are neither source nor target of any relation."""
    ends = read(spark, base, "relations").select(F.explode(F.array(C.blank_to_null(F.col("source")), C.blank_to_null(F.col("target")))).alias("uri")).where("uri is not null").distinct()
    return read(spark, base, "entities").select("uri").where("uri is not null").distinct().join(ends, "uri", "left_anti")


def single_labels(triples: DataFrame) -> DataFrame:
    """(s, label): the one English label of each node, least by lower case, generated from type and name where none is."""
    return _spoken(_described(cut(triples)).where("kind is not null"))


def _described(triples: DataFrame) -> DataFrame:
    """(s, kind, label): the least class and the label of each node that has either."""
    labels = triples.where("p = 'label' and o_lang = 'en'").groupBy("s").agg(F.min_by("o", F.struct(F.lower("o").alias("l"), "o")).alias("label"))
    types = triples.where("p = 'type'").groupBy("s").agg(F.min("o").alias("kind"))
    return types.join(labels, "s", "full").select("s", "kind", "label")


def _spoken(described: DataFrame) -> DataFrame:
    made = F.initcap(F.concat_ws(" ", F.lower("kind"), F.substring_index(C.local_name(F.col("s")), "_", -1)))
    return described.select("s", F.coalesce("label", made).alias("label"))


def node_labels(spark: SparkSession, base: str) -> DataFrame:
    """Names of inferred relations are made once and meet those of the same form in the rest, so that each is labelled once."""
    parts = Parts(spark, base, "p in ('type', 'label')")
    form = F.col("s").rlike(f"^{re.escape(V.KG)}(inferred|evidence)_[0-9a-f]{{16}}\\z")
    given = _described(parts.told.where(form))
    bucket = F.conv(F.substring(F.substring_index("s", "_", -1), 1, 2), 16, 10).cast("int") + F.when(F.startswith("s", F.lit(f"{V.KG}evidence_")), 256).otherwise(0)
    given = given.select(bucket.alias("bucket"), F.lit(None).cast("binary").alias("rest"), "s", "kind", "label")
    rows = parts.made.read(told_apart(located(parts.ids)), NAMED).unionByName(given).repartition(2 * tasks(spark), "bucket")
    made = rows.mapInArrow(labelled(((f"{V.KG}inferred_", "Relation"), (f"{V.KG}evidence_", "Evidence"))), "s string, kind string, label string")
    return _spoken(_described(parts.told.where(~form)).where("kind is not null").unionByName(made))


def relation_duplicates(spark: SparkSession, base: str) -> DataFrame:
    """(source, relation, target, doc_id, winner, copies): relations with one statement and provenance, and the one kept."""
    rows = precise_relations(spark, base)
    rank = F.struct((-F.col("confidence")).alias("c"), F.col("is_inferred").cast("int").alias("i"), "uri")
    return rows.groupBy("source", "relation", "target", "doc_id").agg(F.min_by("uri", rank).alias("winner"), F.count(F.lit(1)).alias("copies")).where("copies > 1")


def spine_violations(triples: DataFrame) -> DataFrame:
    """Relations without exactly one subject, predicate and object."""
    triples = cut(triples)
    rels = triples.where("p = 'type' and o = 'Relation'").select("s").distinct()
    counts = triples.where("p in ('subject', 'predicate', 'object')").groupBy("s").agg(*[F.count_if(F.col("p") == p).alias(p) for p in ("subject", "predicate", "object")])
    return rels.join(counts, "s", "left").na.fill(0).where("subject <> 1 or predicate <> 1 or object <> 1")


def triple_counts(spark: SparkSession, base: str) -> DataFrame:
    parts = Parts(spark, base)
    if not parts.apart():
        return graph_triples(spark, base).groupBy("p", "o_kind").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("s").alias("subjects"))
    fresh = named(parts.statements().where("fresh > 0").withColumnRenamed("id", "s"), parts.ids, ["s"]).select("p", F.lit("iri").alias("o_kind"), "s", F.col("fresh").alias("n"))
    said = parts.told.groupBy("p", "o_kind", "s").agg(F.count(F.lit(1)).alias("n")).unionByName(fresh)
    by_subject = said.groupBy("p", "o_kind", "s").agg(F.sum("n").alias("n")).groupBy("p", "o_kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("subjects"))
    return by_subject.unionByName(parts.node_counts().withColumn("subjects", F.col("n"))).groupBy("p", "o_kind").agg(F.sum("n").alias("n"), F.sum("subjects").alias("subjects"))


def relation_spine(spark: SparkSession, base: str) -> DataFrame:
    """Relations without exactly one subject, predicate and object; an inferred one whose name is its own has them."""
    parts = Parts(spark, base, "p in ('subject', 'predicate', 'object') or (p = 'type' and o = 'Relation')")
    return spine_violations(parts.told if parts.apart(evidence=False) else graph_triples(spark, base))


def pruned_counts(spark: SparkSession, base: str) -> DataFrame:
    """(p, n): the triples that are left when entities which no relation names are gone."""
    parts = Parts(spark, base)
    whole = lambda: pruned(graph_triples(spark, base)).groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    if not parts.apart_and_tallied():
        return whole()
    lone = cut(lone_entities(parts.told, parts.ends()))
    # ends of inferred relations are not lone; no other object of theirs has the form of a lone name, or else the graph is laid out
    if lone.where(~F.contains("s", F.lit("://")) | F.contains("s", F.lit(" ")) | F.startswith("s", F.lit(f"{V.KG}evidence_")) | F.col("s").isin(*[V.KG + x for x in NAMES])).limit(1).count():
        return whole()
    rest = without(parts.told, lone).groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    said = parts.statements().where("fresh > 0").select("p", F.col("fresh").alias("n"))
    return rest.unionByName(said).unionByName(parts.node_counts().select("p", "n")).groupBy("p").agg(F.sum("n").alias("n"))


def check_shapes(triples: DataFrame, held: bool = False) -> DataFrame:
    """(node, shape, path, constraint, severity) of every violation of the shapes, all in one evaluation.

    Shapes are a fixed table joined by class (with its superclasses) and path; counts and value tests come out of one
    aggregate per node and path, the classes of values out of one join. ``held`` triples are cheap to read again."""
    triples = triples if held else cut(triples)
    spark = triples.sparkSession
    schema = "k int, shape string, path string, least int, most int, datatype string, kind string, value_class string, severity string"
    # a shape is moved as its number
    shapes = spark.createDataFrame([(k, *x) for k, x in enumerate(V.SHAPES)], schema)
    closure = F.broadcast(superclasses(spark))
    types = triples.where("p = 'type'").select(F.col("s").alias("node"), F.col("o").alias("class")).distinct()
    every = cut(types.join(closure, "class", "left").select("node", F.coalesce("above", "class").alias("class")).distinct())
    # evidence is also known by its name
    named = triples.where(F.startswith("s", F.lit(f"{V.KG}evidence_"))).select(F.col("s").alias("node"), F.lit("Evidence").alias("class")).distinct()
    focus = every.unionByName(named).distinct().join(F.broadcast(shapes.select("k", "shape", "path")), F.col("class") == F.col("shape")).select("node", "path", "k")
    paths = [x[1] for x in V.SHAPES]
    values = triples.where(F.col("p").isin(*paths)).select(F.col("s").alias("node"), F.col("p").alias("path"), "o", "o_kind", "o_datatype", "o_lang")
    rows = focus.join(values, ["node", "path"], "left").join(F.broadcast(shapes.drop("path")), "k")
    classed = every.select(F.col("node").alias("o"), F.col("class").alias("value_class"), F.lit(True).alias("has_class"))
    # only values that a shape asks the class of are looked up: the others would all meet under one empty key
    asked = F.coalesce((F.col("o_kind") == "iri") & F.col("value_class").isNotNull(), F.lit(False))
    rows = rows.where(asked).join(classed, ["o", "value_class"], "left").unionByName(rows.where(~asked).withColumn("has_class", F.lit(None).cast("boolean")))
    wrong_language = F.col("o").isNotNull() & (F.col("datatype") == "langString") & ~F.coalesce(F.col("o_lang").isin("en"), F.lit(False))
    wrong_type = F.col("o").isNotNull() & F.col("datatype").isNotNull() & (F.coalesce("o_datatype", F.lit("")) != F.col("datatype"))
    wrong_kind = F.col("o").isNotNull() & (F.col("kind") == "IRI") & (F.col("o_kind") != "iri")
    wrong_class = F.col("o").isNotNull() & F.col("value_class").isNotNull() & (F.col("o_kind") == "iri") & F.col("has_class").isNull()
    out_of_range = (F.col("path") == "confidence") & (F.col("o_kind") == "literal") & ~F.coalesce(F.col("o").try_cast("double").between(0.0, 1.0), F.lit(False))
    sums = rows.groupBy("node", "k").agg(
        F.count("o").alias("n"), F.count_if(wrong_type).alias("datatype"), F.count_if(wrong_kind).alias("nodeKind"), F.count_if(wrong_class).alias("class"), F.count_if(out_of_range & F.col("o").isNotNull()).alias("range"), F.count_if(wrong_language).alias("language")
    ).join(F.broadcast(shapes.select("k", "shape", "path", "least", "most", "severity")), "k")
    tests = F.array(
        F.when(F.col("n") < F.col("least"), "minCount"), F.when(F.col("n") > F.col("most"), "maxCount"), F.when(F.col("datatype") > 0, "datatype"), F.when(F.col("nodeKind") > 0, "nodeKind"), F.when(F.col("class") > 0, F.when(F.col("path") == "object", "or").otherwise("class")), F.when(F.col("range") > 0, "range"), F.when(F.col("language") > 0, "languageIn")
    )
    found = sums.select("node", "shape", "path", "severity", F.explode(F.array_compact(tests)).alias("constraint")).select("node", "shape", "path", "constraint", "severity")
    inferred = triples.where("p = 'isInferred' and o = 'true'").select(F.col("s").alias("node")).distinct()
    grounded = triples.where("p in ('inferenceRule', 'wasDerivedFrom')").select(F.col("s").alias("node")).distinct()
    bare = inferred.join(grounded, "node", "left_anti").select("node", F.lit("Relation").alias("shape"), F.lit("isInferred").alias("path"), F.lit("derivation").alias("constraint"), F.lit("Warning").alias("severity"))
    return found.unionByName(bare)


def _whole_report(spark: SparkSession, base: str) -> DataFrame:
    graph = with_closure(graph_triples(spark, base).unionByName(field_assertions(spark, base)))
    return check_shapes(graph, held=True).groupBy("shape", "path", "constraint", "severity").agg(F.count(F.lit(1)).alias("n"))


def _pattern_report(spark: SparkSession) -> DataFrame:
    """(source, target, shape, path, constraint, severity): what is wrong with an inferred relation and its evidence, by whether its
    ends are entities: four of them are laid out and checked."""
    rows = [(f"{V.KG}{'classed' if s else 'bare'}_s", "uses", f"{V.KG}{'classed' if t else 'bare'}_t", 0.5, "transitive", "rule", 1) for s in (0, 1) for t in (0, 1)]
    made = spark.createDataFrame(rows, "source string, relation string, target string, confidence double, rule string, rule_id string, iteration int")
    laid = relation_triples(spark, "", made, made, asserted=False)
    ends = made.select(F.explode(F.array("source", "target")).alias("s")).where(F.contains("s", F.lit("classed"))).distinct()
    found = cut(check_shapes(laid.unionByName(unfold(ends, F.col("s"), [triple("type", F.lit("Entity"), "iri")])).distinct()))
    key = C.short_hash(F.concat_ws("|", "source", "relation", "target"))
    node = F.array(F.concat(F.lit(f"{V.KG}inferred_"), key), F.concat(F.lit(f"{V.KG}evidence_"), C.short_hash(F.concat(key, F.lit("|0")))))
    own = made.select(F.contains("source", F.lit("classed")).alias("source"), F.contains("target", F.lit("classed")).alias("target"), F.explode(node).alias("node"))
    return cut(found.join(own, "node").drop("node"))


def shape_report(spark: SparkSession, base: str) -> DataFrame:
    """Violations per shape, path, constraint and severity; the graph conforms when no row has severity Violation.

    Inferred relations are alike but for the classes of their ends, so they are counted by these; what their statements add
    to their ends is tested by no shape. The node of a field is right by form if its name is its own. Where a name is not, or a
    shape tests such statements, the whole graph is laid out."""
    results = {r[4] for r in RULES}
    tested = any(x[1] in results and (x[2], x[3], x[4], x[6]) != (None, None, None, None) for x in V.SHAPES) or not all(r[1] in V.RULE_IDS for r in RULES)
    parts = Parts(spark, base)
    told, ids = parts.told, parts.ids
    fields = raw_field_triples(spark, base).where("p <> 'type'").select("s", "p").distinct()
    begins = lambda c, *kinds: F.greatest(F.lit(False), *[F.startswith(c, F.lit(V.KG + k)) for k in kinds])
    ends = told.where("p in ('subject', 'object') and o_kind = 'iri'").select(F.col("o").alias("s")).unionByName(ids.select(F.col("name").alias("s"))).distinct()
    odd = told.where(begins("s", "assert_")).select("s").unionByName(ends.where(begins("s", "assert_", "inferred_", "evidence_")))
    if tested or odd.limit(1).count() or not parts.apart() or repeats(packed(fields.select(F.unhex(C.short_hash(F.concat_ws("|", "s", "p")))))):
        return _whole_report(spark, base)
    sources = named(parts.tallied().where("p >= 0").select(F.col("id").alias("s")).distinct(), ids, ["s"])
    ends = told.where("p in ('subject', 'object') and o_kind = 'iri'").select(F.col("o").alias("s")).unionByName(parts.ends()).distinct()
    bare = cut(ends.join(told.select("s").unionByName(sources).distinct(), "s", "left_anti"))
    closed = unfold(bare, F.col("s"), [triple("type", F.lit("Entity"), "iri")])
    freed(spark)
    found = cut(check_shapes(told.unionByName(closed), held=True).groupBy("shape", "path", "constraint", "severity").agg(F.count(F.lit(1)).alias("n")))
    freed(spark)
    kinds = told.where("p = 'type'").select("s", F.col("o").alias("class")).unionByName(bare.select("s", F.lit("Entity").alias("class")))
    entity = [x["class"] for x in superclasses(spark).where("above = 'Entity'").collect()]
    classed = kinds.where(F.col("class").isin("Entity", *entity)).select(F.col("s").alias("name")).distinct()
    classed = cut(ids.join(classed, "name", "left_semi").select("id"))
    made = parts.made.read(by_ends(located(ids), located(classed)), "source boolean, target boolean, n bigint").groupBy("source", "target").agg(F.sum("n").alias("n")).where("n > 0")
    drawn = _pattern_report(spark).join(F.broadcast(cut(made)), ["source", "target"]).select("shape", "path", "constraint", "severity", "n")
    return found.unionByName(drawn).groupBy("shape", "path", "constraint", "severity").agg(F.sum("n").alias("n"))


class ShapeError(RuntimeError):
    """The graph does not conform to its shapes."""


def shape_summary(spark: SparkSession, base: str) -> DataFrame:
    """(severity, n, conforms): violations by severity; the graph conforms where none is a Violation."""
    rows = shape_report(spark, base).groupBy("severity").agg(F.sum("n").alias("n"))
    return rows.join(rows.agg(F.coalesce(F.max((F.col("severity") == "Violation").cast("int")), F.lit(0)).alias("bad")), how="inner", on=F.lit(True)).select("severity", "n", (F.col("bad") == 0).alias("conforms"))


def enforce_shapes(violations: DataFrame) -> None:
    found = violations.where("severity = 'Violation'").groupBy("shape", "path", "constraint").count().orderBy(F.desc("count")).first()
    if found:
        raise ShapeError(f"{found['count']} nodes break {found['shape']}.{found['path']} ({found['constraint']})")


QUERIES = {
    "vote_triples": vote_triples,
    "structure_triples": structure_triples,
    "flat_relations": flat_relations,
    "shape_summary": shape_summary,
    "raw_field_triples": raw_field_triples,
    "triple_counts": triple_counts,
    "isolated_entities": isolated_entities,
    "node_labels": node_labels,
    "relation_duplicates": relation_duplicates,
    "relation_spine": relation_spine,
    "shape_report": shape_report,
    "pruned_counts": pruned_counts,
}
_TRIM = lambda c: f"nullif(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'), '')"
_TS = lambda c: f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%f')"


def _raw_sql() -> str:
    specs = {
        "themes": ("theme", "Theme", [("name", _TRIM("name"), "string"), ("description", _TRIM("description"), "string"), ("domainCategory", _TRIM("domain_category"), "string"), ("problemCategory", _TRIM("problem_category"), "string"), ("modelCategory", _TRIM("model_category"), "string"), ("views", "cast(views as varchar)", "integer"), ("createdAt", _TS("created_at"), "dateTime")]),
        "questions": ("question", "Question", [("title", _TRIM("title"), "string"), ("body", _TRIM("body"), "string"), ("views", "cast(views as varchar)", "integer"), ("createdAt", _TS("created_at"), "dateTime")]),
        "answers": ("answer", "Answer", [("text", _TRIM("body"), "string"), ("createdAt", _TS("created_at"), "dateTime")]),
        "documents": ("document", "Document", [("title", _TRIM("title"), "string"), ("language", _TRIM("lang"), "string"), ("url", _TRIM("url"), "string"), ("createdAt", _TS("created_at"), "dateTime")]),
        "experts": ("expert", "Expert", [("displayName", _TRIM("display_name"), "string"), ("areaOfExpertise", _TRIM("area_of_expertise"), "string"), ("bio", _TRIM("bio"), "string"), ("isDeleted", "cast(is_deleted as varchar)", "boolean"), ("dateJoined", _TS("date_joined"), "dateTime")]),
    }
    parts = []
    for table, (low, kind, fields) in specs.items():
        own = "doc_id" if table == "documents" else "id"
        parts.append(f"select '{V.KG}{low}_' || {own} s, 'type' p, '{kind}' o, 'iri' o_kind, null o_datatype from {table}")
        parts += [f"select '{V.KG}{low}_' || {own}, '{p}', {e}, 'literal', '{t}' from {table}" for p, e, t in fields]
    return " union all ".join(parts)


_RATING = "case regexp_replace(lower(value), '[^a-z0-9]', '', 'g') " + " ".join(f"when '{k}' then '{v}'" for k, v in V.RATINGS.items()) + " end"
_VOTES = f"""vt as (select '{V.KG}vote_' || vote_key s, value, created_at, {BUCKET} b from latest where expert is not null and coalesce(answer_id, 0) <> 0),
vtr as (select s, 'type' p, 'Vote' o, 'iri' o_kind, cast(null as varchar) o_datatype from vt union all select s, 'rawValue', value, 'literal', 'string' from vt union all select s, 'rawVoteValue', cast(try_cast(case when regexp_matches(value, '^[+-]?[0-9]+$') then value end as bigint) as varchar), 'literal', 'integer' from vt
  union all select s, 'voteValue', coalesce(case when b = 'interactsWith' then {_RATING} end, case b when 'endorses' then 'Positive' when 'disagreesWith' then 'Negative' when 'isNeutralOn' then 'Neutral' end), 'iri', null from vt
  union all select s, 'polarity', case b when 'endorses' then 'positive' when 'disagreesWith' then 'negative' else 'neutral' end, 'literal', 'string' from vt union all select s, 'castAt', {_TS("created_at")}, 'literal', 'dateTime' from vt)"""
_STRUCTURE = f"""sdt as (select source s, predicate p, target o from edges where predicate <> 'castBy' union all select source, 'castBy', arg_min(target, struct_pack(c := -confidence, t := target)) from edges where predicate = 'castBy' group by 1
  union all select distinct {_UNIT}, 'mentions', uri from men join texts on k = origin_key where {_S('t')} <> ''),
un as (select {_UNIT} s, k, length(t) n from texts where {_S('t')} <> ''),
stt as (select s, p, o, 'iri' o_kind, cast(null as varchar) o_datatype from sdt union all select s, 'type', 'DiscourseUnit', 'iri', null from un union all select s, 'originKey', k, 'literal', 'string' from un union all select s, 'nChars', cast(n as varchar), 'literal', 'integer' from un)"""
_KEYED = "substr(sha256(concat_ws('|', s, p, o)), 1, 16)"
_RELATIONS = f"""ev as (select r.uri, '{V.KG}evidence_' || substr(sha256(concat_ws('|', r.uri, '0', chunk_index, coalesce(cast(start_char as varchar), 'None'), coalesce(cast(end_char as varchar), 'None'))), 1, 16) evidence, coalesce(r.evidence, concat_ws(' ', {_LOCAL('source')}, relation, {_LOCAL('target')}))[1:500] txt,
  try_cast(nullif(regexp_extract(r.doc_id, '-?\\d+'), '') as bigint) did, case when chunk_index >= 0 then chunk_index end ci, start_char, end_char from rel r join rs using (uri)),
rr as (select '{V.KG}' || k.uri rl, source s, relation p, target o, confidence, is_inferred, cast(null as varchar) rule_id, evidence, txt, did, ci, start_char, end_char, coalesce(extractor, 'unknown') who from kept k left join ev using (uri)
  union all select '{V.KG}inferred_' || {_KEYED}, s, p, o, c, true, {_RULE_ID}, '{V.KG}evidence_' || substr(sha256({_KEYED} || '|0'), 1, 16), concat_ws(' ', {_LOCAL('s')}, p, {_LOCAL('o')}), cast(null as bigint), cast(null as integer), cast(null as bigint), cast(null as bigint), 'reasoner' from allnew),
rrt as (select s, p, o, 'iri' o_kind, cast(null as varchar) o_datatype from rr union all select rl, 'type', 'Relation', 'iri', null from rr union all select rl, 'subject', s, 'iri', null from rr union all select rl, 'predicate', '{V.KG}' || p, 'iri', null from rr union all select rl, 'object', o, 'iri', null from rr
  union all select rl, 'confidence', cast(cast(confidence as double) as varchar), 'literal', 'float' from rr union all select rl, 'isInferred', cast(is_inferred as varchar), 'literal', 'boolean' from rr union all select rl, 'inferenceRule', rule_id, 'literal', 'string' from rr union all select rl, 'hasEvidence', evidence, 'iri', null from rr
  union all select evidence, 'type', 'Evidence', 'iri', null from rr union all select evidence, 'evidenceText', txt, 'literal', 'string' from rr union all select evidence, 'confidence', cast(cast(confidence as double) as varchar), 'literal', 'float' from rr union all select evidence, 'discourse_id', cast(did as varchar), 'literal', 'integer' from rr
  union all select evidence, 'chunk_index', cast(ci as varchar), 'literal', 'integer' from rr union all select evidence, 'start_char', cast(start_char as varchar), 'literal', 'integer' from rr union all select evidence, 'end_char', cast(end_char as varchar), 'literal', 'integer' from rr union all select evidence, 'source', who, 'literal', 'string' from rr)"""
_ENTITIES = f"""ent as (select uri s, 'type' p, entity_type o, 'iri' o_kind, cast(null as varchar) o_datatype, cast(null as varchar) o_lang from reg union all select uri, 'label', {_TRIM("label")}, 'literal', 'langString', 'en' from reg
  union all select uri, 'confidence', cast(cast(confidence as double) as varchar), 'literal', 'float', null from reg union all select uri, 'ontology_uri', ontology_uri, 'iri', null, null from reg)"""
_INFERRED = _fixpoint_sql(3).removeprefix(f"with {BASE}, ")
#: All tables of the graph as one statement's beginning; ``tri`` are its triples.
GRAPH = f"""with recursive {PRECISE}, {_INFERRED}, {_REG}, {LATEST}, {EDGES}, {MENTIONS}, {_TEXTS}, {_RSPANS}, {_VOTES}, {_STRUCTURE}, {_RELATIONS}, {_ENTITIES},
tri as materialized (select distinct * from (select s, p, o, o_kind, o_datatype, cast(null as varchar) o_lang from ({_raw_sql()}) union all select *, null from vtr union all select *, null from stt union all select *, null from rrt union all select * from ent) where s is not null and o is not null)"""
_CLOSED = "cl as (with recursive t(c, a) as (values " + ", ".join(f"('{a}', '{b}')" for a, b in V.SUBCLASS_OF.items()) + "), w(c, a) as (select c, c from t union select a, a from t union select w.c, t.a from w join t on t.c = w.a) select c as class, a as above from w)"
_lit = lambda x: "null" if x is None else str(x) if isinstance(x, int) else f"'{x}'"
_KINDS = ", ".join(f"'{k}'" for k in ("Theme", "Question", "Answer", "Expert", "Relation", "Evidence", "FieldAssertion", "Vote", "Document", "DiscourseUnit"))
_SHAPES = f"""{_CLOSED}, fa as (select '{V.KG}assert_' || substr(sha256(concat_ws('|', s, p)), 1, 16) a, s, p, o from ({_raw_sql()}) where o is not null and p <> 'type'),
fat as (select a s, 'type' p, 'FieldAssertion' o, 'iri' o_kind, cast(null as varchar) o_datatype, cast(null as varchar) o_lang from fa union all select a, 'fieldName', p, 'literal', 'string', null from fa union all select a, 'recordId', regexp_extract(s, '[^_]*$'), 'literal', 'string', null from fa union all select a, 'sourceSection', regexp_extract(regexp_extract(s, '[^#]*$'), '^[^_]*'), 'literal', 'string', null from fa
  union all select a, 'assertedPredicate', '{V.KG}' || p, 'iri', null, null from fa union all select a, 'assertedValue', o, 'literal', 'string', null from fa union all select a, 'wasDerivedFrom', s, 'iri', null, null from fa),
t0 as (select * from tri union all select * from fat), bare as (select distinct o s from t0 where p in ('subject', 'object') and o_kind = 'iri' and o not in (select s from t0)),
tt as materialized (select * from t0 union all select s, 'type', 'Entity', 'iri', null, null from bare),
sh(shape, path, least, most, datatype, kind, value_class, severity) as (values {", ".join("(" + ", ".join(map(_lit, x)) + ")" for x in V.SHAPES)}),
ty as (select distinct s node, o class from tt where p = 'type'), evy as materialized (select distinct node, coalesce(above, class) class from ty left join cl using (class)),
fo as (select node, sh.* from (select * from evy union select s, 'Evidence' from tt where starts_with(s, '{V.KG}evidence_')) f join sh on f.class = sh.shape),
rv as (select fo.*, v.o, v.o_kind, v.o_datatype, v.o_lang, h.node hc from fo left join tt v on v.s = fo.node and v.p = fo.path left join evy h on h.node = v.o and h.class = fo.value_class and v.o_kind = 'iri'),
sm as (select node, shape, path, least, most, severity, count(o) n, count(*) filter (o is not null and datatype is not null and coalesce(o_datatype, '') <> datatype) dtn, count(*) filter (o is not null and kind = 'IRI' and o_kind <> 'iri') nk, count(*) filter (o is not null and value_class is not null and o_kind = 'iri' and hc is null) cn,
  count(*) filter (o is not null and path = 'confidence' and o_kind = 'literal' and not coalesce(try_cast(o as double) between 0 and 1, false)) rn, count(*) filter (o is not null and datatype = 'langString' and coalesce(o_lang, '') <> 'en') ln from rv group by 1, 2, 3, 4, 5, 6),
fd as (select node, shape, path, unnest(list_filter([case when n < least then 'minCount' end, case when n > most then 'maxCount' end, case when dtn > 0 then 'datatype' end, case when nk > 0 then 'nodeKind' end, case when cn > 0 then case when path = 'object' then 'or' else 'class' end end, case when rn > 0 then 'range' end, case when ln > 0 then 'languageIn' end], lambda x: x is not null)) c, severity from sm),
vio as (select * from fd union all select distinct s, 'Relation', 'isInferred', 'derivation', 'Warning' from tt where p = 'isInferred' and o = 'true' and s not in (select s from tt where p in ('inferenceRule', 'wasDerivedFrom'))),
rep as (select shape, path, c as "constraint", severity, count(*) n from vio group by 1, 2, 3, 4)"""
ORACLE = {
    "vote_triples": f"with {LATEST}, {_VOTES} select s, p, o, o_kind, o_datatype, cast(null as varchar) as o_lang from vtr where s is not null and o is not null",
    "structure_triples": f"with {LATEST}, {EDGES}, {MENTIONS}, {_TEXTS}, {_STRUCTURE} select s, p, o, o_kind, o_datatype, cast(null as varchar) as o_lang from stt where s is not null and o is not null",
    "flat_relations": f"{GRAPH}, fl as (select 'asserted' sec, relation p from kept union all select 'inferred', p from allnew union all select 'structure', predicate from edges union all select 'mentions', 'mentions' from (select distinct k, uri from men join texts on k = origin_key where {_S('t')} <> '')) select sec as section, p as predicate, count(*) as n from fl group by 1, 2",
    "triple_counts": f"{GRAPH} select p, o_kind, count(*) as n, count(distinct s) as subjects from tri group by 1, 2",
    "node_labels": f"{GRAPH}, lb as (select s, arg_min(o, struct_pack(l := lower(o), o := o)) label from tri where p = 'label' and o_lang = 'en' group by 1), ty as (select s, min(o) kind from tri where p = 'type' group by 1), tl as (select *, regexp_extract({_LOCAL('s')}, '[^_]*$') t from ty) select s, coalesce(label, upper(kind[1]) || lower(kind[2:]) || ' ' || upper(t[1]) || lower(t[2:])) as label from tl left join lb using (s)",
    "relation_spine": f"{GRAPH}, c as (select r.s, count(*) filter (t.p = 'subject') subject, count(*) filter (t.p = 'predicate') predicate, count(*) filter (t.p = 'object') object from (select s from tri where p = 'type' and o = 'Relation') r left join tri t on t.s = r.s group by 1) select * from c where subject <> 1 or predicate <> 1 or object <> 1",
    "pruned_counts": f"{GRAPH}, used as (select distinct o s from tri where p in ('subject', 'object') and o_kind = 'iri'), lone as materialized (select distinct s from tri where p = 'type' and s not in (select s from used) and s not in (select s from tri where p = 'type' and o in ({_KINDS}))) select p, count(*) as n from tri where s not in (select s from lone) and o not in (select s from lone) group by 1",
    "shape_report": f"{GRAPH}, {_SHAPES} select * from rep",
    "shape_summary": f"{GRAPH}, {_SHAPES} select severity, cast(sum(n) as bigint) as n, (select count(*) from rep where severity = 'Violation') = 0 as conforms from rep group by 1",
    "raw_field_triples": f"select s, p, o, o_kind, o_datatype, cast(null as varchar) as o_lang from ({_raw_sql()}) where o is not null",
    "isolated_entities": f"select distinct uri from entities e where uri is not null and not exists (select 1 from relations r where {_TRIM('r.source')} = e.uri) and not exists (select 1 from relations r where {_TRIM('r.target')} = e.uri)",
    "relation_duplicates": f"with {PRECISE} select source, relation, target, doc_id, arg_min(uri, (-confidence, is_inferred::int, uri)) as winner, count(*) as copies from kept group by 1, 2, 3, 4 having count(*) > 1",
}
