"""SQL counterparts of the queries that SQL can express, written from the contracts."""

# Written out here, not imported: a wrong phrase or notice in the operator has to show.
_TEMPLATES = """
    (0, 'mit', true, 'mit license'),
    (1, 'apache', true, 'apache license'),
    (2, 'gpl', true, 'general public license'),
    (3, 'agpl', false, 'gnu affero general public license'),
    (4, 'apache', false, 'licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license'),
    (5, 'bsd', false, 'redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met'),
    (6, 'cc-by', false, 'this work is licensed under a creative commons attribution'),
    (7, 'gpl', false, 'this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation'),
    (8, 'isc', false, 'permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted'),
    (9, 'lgpl', false, 'gnu lesser general public license'),
    (10, 'mit', false, 'permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files'),
    (11, 'mpl', false, 'this source code form is subject to the terms of the mozilla public license'),
    (12, 'unlicense', false, 'this is free and unencumbered software released into the public domain')
"""

ORACLES = {
    "op1_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
             g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
        FROM t JOIN g USING (text)
    """,
    "op4_license_scan": rf"""
        WITH templates(template, label, is_phrase, phrase) AS (VALUES {_TEMPLATES}),
        pieces AS (SELECT template, string_split(phrase, ' ') AS w FROM templates),
        placed AS (SELECT template, unnest(w) AS t0, unnest(range(len(w))) AS place FROM pieces),
        grams AS (
          SELECT * FROM (SELECT *, lead(t0) OVER (PARTITION BY template ORDER BY place) AS t1 FROM placed) WHERE t1 IS NOT NULL
        ),
        sizes AS (SELECT template, count(*) AS n_grams FROM grams GROUP BY 1),
        texts AS (
          SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
          FROM documents
        ),
        words AS (SELECT rid, unnest(w) AS w0, unnest(range(len(w))) AS pos FROM texts),
        pairs AS (SELECT *, lead(w0) OVER (PARTITION BY rid ORDER BY pos) AS w1 FROM words),
        votes AS (
          SELECT rid, template, pos - place AS diagonal, list(DISTINCT place) AS found
          FROM pairs JOIN grams ON w0 = t0 AND w1 = t1 GROUP BY ALL
        ),
        steps AS (SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal) AS step FROM votes),
        spans AS (
          SELECT *, sum(CASE WHEN step > 2 THEN 1 ELSE 0 END) OVER (PARTITION BY rid, template ORDER BY diagonal) AS span FROM steps
        ),
        measured AS (
          SELECT rid, template, label, is_phrase, len(list_distinct(flatten(list(found)))) / any_value(n_grams) AS coverage,
            count(*) FILTER (is_phrase AND len(found) = n_grams) AS n_places,
            min(diagonal) FILTER (is_phrase AND len(found) = n_grams) AS first_word,
            max(diagonal) FILTER (is_phrase AND len(found) = n_grams) AS last_word
          FROM spans JOIN sizes USING (template) JOIN templates USING (template) GROUP BY rid, template, span, label, is_phrase
        ),
        whole AS (
          SELECT rid, sum(n_places)::BIGINT AS n_base, min(first_word) AS first_word, max(last_word) AS last_word,
            list(DISTINCT label) FILTER (n_places > 0) AS base,
            list(DISTINCT label) FILTER (n_places > 0 OR NOT is_phrase AND coverage >= 0.75) AS labels,
            max(CASE WHEN NOT is_phrase OR n_places > 0 THEN coverage ELSE 0 END) AS score
          FROM measured GROUP BY rid
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
          coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
          coalesce(array_to_string(list_sort(labels), ','), '') AS labels, coalesce(score, 0)::DOUBLE AS score
        FROM texts LEFT JOIN whole USING (rid)
    """,
    "op13_ranked_search": r"""
        WITH lowered AS (
          SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
          FROM documents
        ),
        totals AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM lowered WHERE len(w) > 0),
        tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM lowered) GROUP BY ALL),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        asked AS (
          SELECT row_number() OVER () AS qid, item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
          FROM benchmark
        ),
        terms AS (SELECT qid, item_id, term, count(*) AS times FROM (SELECT qid, item_id, unnest(w) AS term FROM asked) GROUP BY ALL),
        weights AS (
          SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight FROM df, totals
        ),
        lengths AS (SELECT rid, doc_id, 100 - 75 + (75 * len(w) * n_docs) // n_terms AS m FROM lowered, totals WHERE len(w) > 0),
        scored AS (
          SELECT qid, item_id, rid, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
          FROM terms JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (rid) GROUP BY ALL
        )
        SELECT item_id, (row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS FIRST, rid))::INTEGER AS rank, doc_id, score
        FROM scored WHERE score > 0
        QUALIFY rank <= 10
    """,
}
