"""Registered queries of the corpus operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import automata, bcr, chaining, dualtree, grace, langid, mixing, nbsvm, packing, parity, pii, toxicity, vamana
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vamana_search": lambda spark, sf_dir: vamana.neighbours_of(table(spark, sf_dir, "embeddings")),
    "op2_repeated_strings": lambda spark, sf_dir: bcr.repeats_of(table(spark, sf_dir, "documents")),
    "op3_chained_passages": lambda spark, sf_dir: chaining.passages_of(table(spark, sf_dir, "documents")),
    "op4_parity_sketch_join": lambda spark, sf_dir: parity.jaccard_groups_of(table(spark, sf_dir, "documents")),
    "op5_mixture_packing": lambda spark, sf_dir: packing.packed_documents(table(spark, sf_dir, "documents")),
    "op6_language_id": lambda spark, sf_dir: langid.language_of(table(spark, sf_dir, "documents")),
    "op7_toxic_spans": lambda spark, sf_dir: toxicity.toxicity_of(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op8_raked_mixture": lambda spark, sf_dir: mixing.mixture_of(table(spark, sf_dir, "documents")),
    "op9_grace_dedup": lambda spark, sf_dir: grace.exact_groups_of(table(spark, sf_dir, "documents")),
    "op10_disclosure_sanitising": lambda spark, sf_dir: pii.personal_data_of(table(spark, sf_dir, "documents")),
    "op11_nb_support_vectors": lambda spark, sf_dir: nbsvm.quality_of(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op12_dual_tree_search": lambda spark, sf_dir: dualtree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op13_count_transducers": lambda spark, sf_dir: automata.collocations(table(spark, sf_dir, "documents")),
}

ORACLE: dict[str, str] = {
    "op9_grace_dedup": """
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
                   FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
               sha256(norm) AS text_sha256
        FROM t WINDOW g AS (PARTITION BY norm)""",
    "op12_dual_tree_search": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
             q AS (SELECT item_id, t, count(*) AS repeats
                   FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark)
                   GROUP BY ALL),
             total AS (SELECT count(*) AS big_n, CAST(sum(len(terms)) AS BIGINT) AS big_l FROM d WHERE len(terms) > 0),
             tf AS (SELECT doc_id, t, count(*) AS tf, any_value(n) AS n
                    FROM (SELECT doc_id, unnest(terms) AS t, len(terms) AS n FROM d) WHERE t IN (SELECT t FROM q) GROUP BY doc_id, t),
             w AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY t),
             s AS (SELECT item_id, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * big_n) // big_l))))) AS BIGINT) AS score
                   FROM q JOIN tf USING (t) JOIN w USING (t), total GROUP BY item_id, doc_id)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM s WHERE score > 0 QUALIFY rank <= 10""",
    "op13_count_transducers": r"""
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                               'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
             words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
             total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
             grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
                       FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest(range(1, 6)) AS k))),
             f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING f >= 100),
             inside AS (SELECT DISTINCT lang, f, unnest([array_to_string(string_split(phrase, ' ')[1:k - 1], ' '),
                                                         array_to_string(string_split(phrase, ' ')[2:k], ' ')]) AS phrase FROM f WHERE k > 2),
             cuts AS (SELECT lang, k, phrase, f AS a, unnest(range(1, k)) AS c
                      FROM f WHERE k > 1 AND NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = f.lang AND i.phrase = f.phrase AND i.f = f.f)),
             scored AS (SELECT lang, cuts.phrase, a, x.f AS l, y.f AS r, n, c,
                               CAST((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
                        FROM cuts JOIN f x USING (lang) JOIN f y USING (lang) JOIN total USING (lang)
                        WHERE x.phrase = array_to_string(string_split(cuts.phrase, ' ')[1:c], ' ')
                          AND y.phrase = array_to_string(string_split(cuts.phrase, ' ')[c + 1:cuts.k], ' ')),
             best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
        SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS INTEGER) AS rank, phrase, a, l, r, n, score
        FROM best QUALIFY rank <= 2000""",
}
