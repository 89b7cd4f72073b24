"""Schemas of the tables, each with extra columns whose names clash with names operators use inside."""

TS = "timestamp_ntz"
SCHEMAS = {
    "themes": f"id bigint, name string, description string, domain_category string, problem_category string, model_category string, views bigint, expert_id bigint, created_at {TS}, ingested_at {TS}, key string, n int",
    "questions": f"id bigint, theme_id string, title string, body string, views bigint, expert_id bigint, created_at {TS}, ingested_at {TS}, status string, salt int, hot boolean",
    "answers": f"id bigint, question_id bigint, theme_id bigint, expert_id bigint, parent_id bigint, body string, created_at {TS}, ingested_at {TS}, text string, origin string, start int, pieces int",
    "votes": f"id bigint, expert_id string, answer_id bigint, vote_value string, created_at {TS}, updated_at {TS}, ingested_at {TS}, child_id string, month string",
    "experts": f"id bigint, user_id bigint, display_name string, area_of_expertise string, bio string, is_deleted boolean, date_joined {TS}, profile_picture string, ingested_at {TS}, text string, record_id string",
    "deletions": f"table_name string, record_id bigint, deleted_at {TS}, key string, gone int",
    "entities": "uri string, label string, entity_type string, ontology_uri string, confidence double, start_char bigint, end_char bigint, doc_id string, source string, additional_ontologies map<string,string>, metadata map<string,string>, record string, item string, kind string, node string",
    "relations": f"uri string, source string, relation string, target string, ontology_uri string, confidence double, is_inferred boolean, context string, doc_id string, metadata map<string,string>, extracted_at {TS}, _s string, rank int, vote int, field string, value string",
    "link_decisions": f"decision_id string, input_label string, norm_label string, chosen_canonical_uri string, rule string, scores map<string,double>, source_ids array<string>, decided_at {TS}, a string, b string, root string, uris array<string>",
    "documents": f"doc_id bigint, title string, text string, lang string, source string, theme_id bigint, url string, created_at {TS}, n_chars bigint, ids string, tokens string, terms string, grade double, unit string",
    "reading_labels": f"doc_id bigint, rater_id bigint, band string, rated_at {TS}, grade string, score double",
    "mix_targets": "source string, target_share double, max_repeats bigint, available bigint, documents bigint",
}


def write_tables(spark, base, rows):
    for name, schema in SCHEMAS.items():
        names = [c.strip().split()[0] for c in _columns(schema)]
        data = [tuple(r.get(c) for c in names) for r in rows.get(name, [])]
        spark.createDataFrame(data, schema).write.mode("overwrite").parquet(f"{base}/{name}.parquet")
    return base


def _columns(schema):
    out, depth, at = [], 0, 0
    for k, ch in enumerate(schema):
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and depth == 0:
            out.append(schema[at:k])
            at = k + 1
    return [*out, schema[at:]]
