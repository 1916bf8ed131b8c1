"""DuckDB SQL oracles for the registered queries (correctness gate).

Pre-tokens: DuckDB's RE2 has no look-ahead, so ``\\s+(?!\\S)`` is emulated by
inserting U+E000 between a white-space run and its last character when a
non-space follows, then matching a look-ahead-free pattern that never matches
U+E000.  Tokens are hex strings ``<68><65>``; a merge is DuckDB ``replace`` (also
left to right, non-overlapping); training is N unrolled CTEs.
"""

from __future__ import annotations

from pairforge.functions.patterns import DEFAULT_SPECIAL_TOKEN, WHITESPACE_CLASS

SP = DEFAULT_SPECIAL_TOKEN
N = 16
W = WHITESPACE_CLASS


def pt(x: str) -> str:
    marked = f"regexp_replace({x}, '([{W}])([{W}][^{W}])', '\\1' || chr(57344) || '\\2', 'g')"
    pat = (f"'''(?:[sdmt]|ll|ve|re)| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{W}\\p{{L}}\\p{{N}}\\x{{E000}}]+|[{W}]+'")
    return f"regexp_extract_all({marked}, {pat})"


def norm_lines(x: str) -> str:
    return (f"regexp_extract_all(replace(replace({x}, chr(13) || chr(10), chr(10)), chr(13), chr(10)), "
            f"'[^\\n]*\\n|[^\\n]+')")


def alpha_byte(b: str) -> str:
    return (f"CASE WHEN ({b} BETWEEN 33 AND 126) OR ({b} BETWEEN 161 AND 172) OR ({b} BETWEEN 174 AND 255) "
            f"THEN chr({b}) WHEN {b} < 33 THEN chr(256 + {b}) WHEN {b} < 161 THEN chr(256 + {b} - 94) "
            f"ELSE chr(256 + 67) END")


def alpha_hex(h: str) -> str:
    b = alpha_byte("('0x' || x)::INTEGER")
    return f"array_to_string(list_transform(regexp_extract_all({h}, '..'), lambda x: {b}), '')"


def toks(src: str, key: str, text: str = "text") -> str:
    """Rows ``key, seg, pos, w`` of the pre-tokens of ``src`` (split at the special)."""
    return (f"SELECT {key}, seg, unnest(p) AS w, generate_subscripts(p, 1) AS pos FROM ("
            f"SELECT {key}, seg, {pt('t')} AS p FROM ("
            f"SELECT {key}, unnest(string_split({text}, '{SP}')) AS t, "
            f"generate_subscripts(string_split({text}, '{SP}'), 1) AS seg FROM {src}))")


def words_of(toks_cte: str) -> str:
    return f"SELECT w, count(*)::BIGINT AS n FROM {toks_cte} GROUP BY w"


def split_tokens(seq: str) -> str:
    return f"string_split(trim(replace({seq}, '><', ' '), '<>'), ' ')"


def chain(p: str, words: str, k: int = N) -> list[str]:
    """CTEs {p}w0..{p}w{k} (word, seq, n) and {p}p1..{p}p{k} (chosen pair l, r, n)."""
    out = [f"{p}w0 AS MATERIALIZED (SELECT w, regexp_replace(hex(encode(w)), '(..)', '<\\1>', 'g') AS seq, n "
           f"FROM {words})"]
    for i in range(1, k + 1):
        out.append(
            f"{p}p{i} AS MATERIALIZED (SELECT l, r, n FROM (SELECT t[i] AS l, t[i + 1] AS r, sum(n) AS n FROM ("
            f"SELECT t, n, unnest(range(1, len(t))) AS i FROM (SELECT {split_tokens('seq')} AS t, n "
            f"FROM {p}w{i - 1}) WHERE len(t) > 1) GROUP BY 1, 2) ORDER BY n DESC, l DESC, r DESC LIMIT 1)")
        out.append(
            f"{p}w{i} AS MATERIALIZED (SELECT w, replace(seq, '<' || l || '><' || r || '>', '<' || l || r || '>') "
            f"AS seq, {p}w{i - 1}.n FROM {p}w{i - 1}, {p}p{i})")
    return out


def merges_cte(p: str, k: int = N) -> str:
    parts = [f"SELECT {i - 1}::INTEGER AS rank, l AS left_hex, r AS right_hex FROM {p}p{i}" for i in range(1, k + 1)]
    return f"{p}merges AS (" + " UNION ALL ".join(parts) + ")"


def vocab_cte(p: str, k: int = N) -> str:
    parts = ["SELECT i::INTEGER AS id, printf('%02X', i) AS hex, 'byte' AS kind FROM range(256) t(i)",
             f"SELECT 256::INTEGER, hex(encode('{SP}')), 'special'"]
    parts += [f"SELECT {256 + i}::INTEGER, l || r, 'merge' FROM {p}p{i}" for i in range(1, k + 1)]
    return f"{p}vocab AS (" + " UNION ALL ".join(parts) + ")"


def apply_chain(p: str, words: str, k: int = N) -> str:
    """Merged seq of arbitrary words with the k merges of chain ``p``: (w, seq)."""
    seq = "regexp_replace(hex(encode(w)), '(..)', '<\\1>', 'g')"
    for i in range(1, k + 1):
        a = f"{p}p{i}"
        seq = f"replace({seq}, '<' || {a}.l || '><' || {a}.r || '>', '<' || {a}.l || {a}.r || '>')"
    frm = ", ".join([words] + [f"{p}p{i}" for i in range(1, k + 1)])
    return f"SELECT w, {seq} AS seq FROM {frm}"


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def doc_training(p: str = "a", where: str = "TRUE") -> list[str]:
    return [f"{p}toks AS ({toks(f'(SELECT * FROM documents WHERE {where})', 'doc_id')})",
            f"{p}words AS ({words_of(p + 'toks')})"] + chain(p, f"{p}words") + [merges_cte(p), vocab_cte(p)]


def encoded_ids(p: str, toks_cte: str, key: str, enc_words: str) -> list[str]:
    """CTE {p}ids: key, seg, pos, tp, id for every token of ``toks_cte``."""
    return [
        f"{p}tokhex AS (SELECT {key}, seg, pos, unnest({split_tokens('e.seq')}) AS th, "
        f"generate_subscripts({split_tokens('e.seq')}, 1) AS tp FROM {toks_cte} JOIN {enc_words} e USING (w))",
        f"{p}ids AS (SELECT {key}, seg, pos, tp, v.id FROM {p}tokhex JOIN avocab v ON v.hex = th)",
    ]


def _pairs_sql(words: str) -> str:
    return (f"SELECT ('0x' || substr(h, 2 * i + 1, 2))::INTEGER AS \"left\", "
            f"('0x' || substr(h, 2 * i + 3, 2))::INTEGER AS \"right\", n, h FROM ("
            f"SELECT h, n, unnest(range(0, strlen(h) // 2 - 1)) AS i FROM (SELECT hex(encode(w)) AS h, n FROM {words}))")


def oracle_sql() -> dict[str, str]:
    docs_toks = f"dtoks AS ({toks('documents', 'doc_id')})"
    docs_words = f"dwords AS ({words_of('dtoks')})"
    base = [docs_toks, docs_words]
    train = doc_training("a")
    q: dict[str, str] = {}
    q["pretoken_counts"] = with_(base, "SELECT w AS word, n FROM dwords")
    q["pretoken_counts_by_lang"] = with_(
        [f"t AS ({toks('documents', 'doc_id, lang')})"],
        "SELECT lang, w AS word, count(*)::BIGINT AS n FROM t GROUP BY lang, w")
    q["pretoken_counts_conversations"] = with_(
        [f"t AS ({toks('conversations', 'conv_id, turn, role')})"],
        "SELECT role, w AS word, count(*)::BIGINT AS n FROM t GROUP BY role, w")
    q["pretoken_counts_pages"] = with_(
        [f"t AS ({toks('pages', 'page_id', 'html')})"],
        "SELECT w AS word, count(*)::BIGINT AS n FROM t GROUP BY w")
    q["pretokens_per_document"] = (
        f"SELECT doc_id, len(flatten(list_transform(string_split(text, '{SP}'), lambda s: {pt('s')})))::BIGINT "
        f"AS n_pretokens FROM documents")
    q["pretoken_alphabet"] = with_(base, f"SELECT w AS word, {alpha_hex('hex(encode(w))')} AS display, n FROM dwords")
    q["split_on_special"] = (
        f"SELECT doc_id, (generate_subscripts(parts, 1) - 1)::INTEGER AS part, unnest(parts) AS text FROM ("
        f"SELECT doc_id, string_split(replace(text, chr(10), '{SP}'), '{SP}') AS parts FROM documents)")
    q["split_on_special_list"] = (
        f"SELECT doc_id, (generate_subscripts(parts, 1) - 1)::INTEGER AS part, unnest(parts) AS text FROM ("
        f"SELECT doc_id, regexp_split_to_array(replace(replace(text, chr(10), '{SP}'), ', ', '<|end'), "
        f"'<\\|endoftext\\|>|<\\|end') AS parts FROM documents)")
    q["byte_histogram"] = with_(base, (
        "SELECT ('0x' || h)::INTEGER AS byte, sum(n)::BIGINT AS n FROM ("
        "SELECT unnest(regexp_extract_all(hex(encode(w)), '..')) AS h, n FROM dwords) GROUP BY 1"))
    q["line_counts"] = f"SELECT doc_id, len({norm_lines('text')})::BIGINT AS n_lines FROM documents"
    q["pair_counts"] = with_(base + [f"pp AS ({_pairs_sql('dwords')})"],
                             'SELECT "left", "right", sum(n)::BIGINT AS n FROM pp GROUP BY 1, 2')
    q["pair_counts_accumulated"] = with_(
        [f"te AS ({toks('(SELECT * FROM documents WHERE lang = ' + chr(39) + 'en' + chr(39) + ')', 'doc_id')})",
         f"tr AS ({toks('(SELECT * FROM documents WHERE lang IS NULL OR lang <> ' + chr(39) + 'en' + chr(39) + ')', 'doc_id')})",
         f"we AS ({words_of('te')})", f"wr AS ({words_of('tr')})",
         f"pe AS ({_pairs_sql('we')})", f"pr AS ({_pairs_sql('wr')})",
         'ce AS (SELECT "left", "right", sum(n) AS n FROM pe GROUP BY 1, 2)',
         'cr AS (SELECT "left", "right", sum(n) AS n FROM pr GROUP BY 1, 2)'],
        'SELECT "left", "right", sum(n)::BIGINT AS n FROM (SELECT * FROM ce UNION ALL SELECT * FROM cr) GROUP BY 1, 2')
    q["pair_index_size"] = with_(base + [f"pp AS ({_pairs_sql('dwords')})"],
                                 'SELECT "left", "right", count(DISTINCT h)::BIGINT AS n_words FROM pp GROUP BY 1, 2')
    ranked = ('SELECT printf(\'%02X\', "left") AS lh, printf(\'%02X\', "right") AS rh, sum(n)::BIGINT AS n '
              'FROM pp GROUP BY 1, 2')
    q["top_pairs_20"] = with_(base + [f"pp AS ({_pairs_sql('dwords')})", f"c AS ({ranked})"], (
        "SELECT (row_number() OVER (ORDER BY n DESC, lh DESC, rh DESC) - 1)::INTEGER AS rank, "
        "lh AS left_hex, rh AS right_hex, n FROM c ORDER BY n DESC, lh DESC, rh DESC LIMIT 20"))
    one = base + chain("m", "dwords", 1)
    q["merge_once"] = with_(one, f"SELECT w AS word, len({split_tokens('seq')})::INTEGER AS n_tokens FROM mw1")
    q["affected_words"] = with_(base + chain("m", "dwords", 1)[:2], (
        "SELECT w AS word, n FROM mw0 WHERE contains(seq, (SELECT '<' || l || '><' || r || '>' FROM mp1))"))
    q["pair_counts_after_merge_delta"] = with_(one, (
        "SELECT t[i] AS left_hex, t[i + 1] AS right_hex, sum(n)::BIGINT AS n FROM ("
        f"SELECT t, n, unnest(range(1, len(t))) AS i FROM (SELECT {split_tokens('seq')} AS t, n FROM mw1)) "
        "GROUP BY 1, 2"))
    q["train_merges_16"] = with_(train, "SELECT rank, left_hex, right_hex FROM amerges")
    q["train_merges_16_delta"] = q["train_merges_16"]
    q["train_vocab_16"] = with_(train, "SELECT id, hex, kind FROM avocab")
    q["longest_token"] = with_(train, "SELECT id, (strlen(hex) // 2)::INTEGER AS n_bytes, hex FROM avocab "
                                      "ORDER BY strlen(hex) DESC, id ASC LIMIT 1")
    q["vocab_size"] = with_(train, "SELECT count(*)::BIGINT AS vocab_size FROM avocab")
    q["merges_text"] = with_(train, f"SELECT rank, {alpha_hex('left_hex')} || ' ' || {alpha_hex('right_hex')} "
                                    f"AS line FROM amerges")
    en_fr = doc_training("e", "lang = 'en'") + doc_training("f", "lang = 'fr'")
    q["merges_diff_by_lang"] = with_(en_fr, (
        "SELECT coalesce(a.rank, b.rank) AS rank, a.left_hex AS a_left, a.right_hex AS a_right, "
        "b.left_hex AS b_left, b.right_hex AS b_right, "
        "(a.left_hex IS NOT DISTINCT FROM b.left_hex AND a.right_hex IS NOT DISTINCT FROM b.right_hex) AS same "
        "FROM emerges a FULL OUTER JOIN fmerges b ON a.rank = b.rank"))
    q["vocab_set_difference"] = with_(en_fr, (
        "SELECT hex, 'only_a' AS side FROM (SELECT hex FROM evocab EXCEPT SELECT hex FROM fvocab) "
        "UNION ALL SELECT hex, 'only_b' AS side FROM (SELECT hex FROM fvocab EXCEPT SELECT hex FROM evocab)"))

    # encode / decode with the 16-merge model of all documents
    doc_enc = train + encoded_ids("d", "atoks", "doc_id", "aw16") + [
        "denc AS (SELECT x.doc_id, x.lang, count(i.id)::INTEGER AS n_tokens, "
        "coalesce(string_agg(i.id::VARCHAR, ' ' ORDER BY i.seg, i.pos, i.tp), '') AS ids_text "
        "FROM documents x LEFT JOIN dids i USING (doc_id) GROUP BY x.doc_id, x.lang)"]
    q["encode_documents_16"] = with_(doc_enc, "SELECT doc_id, n_tokens, ids_text FROM denc")
    lines = (f"SELECT doc_id, (generate_subscripts(ls, 1) - 1)::INTEGER AS line_no, unnest(ls) AS text FROM ("
             f"SELECT doc_id, {norm_lines('text')} AS ls FROM documents)")
    line_enc = train + [f"lines AS ({lines})", f"ltoks AS ({toks('lines', 'doc_id, line_no')})",
                        f"lw AS (SELECT DISTINCT w FROM ltoks)", f"lenc AS ({apply_chain('a', 'lw')})"
                        ] + encoded_ids("l", "ltoks", "doc_id, line_no", "lenc") + [
        "linenc AS (SELECT doc_id, line_no, count(*)::INTEGER AS n_tokens, "
        "string_agg(id::VARCHAR, ' ' ORDER BY seg, pos, tp) AS ids_text FROM lids GROUP BY doc_id, line_no)"]
    q["encode_lines_16"] = with_(line_enc, "SELECT doc_id, line_no, n_tokens, ids_text FROM linenc")
    q["token_totals_by_lang"] = with_(doc_enc, "SELECT lang, sum(n_tokens)::BIGINT AS n_tokens FROM denc "
                                               "WHERE n_tokens > 0 GROUP BY lang")
    q["token_total_weighted"] = with_(doc_enc, "SELECT coalesce(sum(n_tokens), 0)::BIGINT AS n_tokens FROM denc")
    conv = train + [f"ctoks AS ({toks('conversations', 'conv_id, turn, role')})",
                    f"cw AS (SELECT role, w, count(*) AS n FROM ctoks GROUP BY role, w)",
                    f"cdw AS (SELECT DISTINCT w FROM cw)", f"cenc AS ({apply_chain('a', 'cdw')})"]
    q["token_totals_by_role"] = with_(conv, (
        f"SELECT role, sum(n * len({split_tokens('cenc.seq')}))::BIGINT AS n_tokens FROM cw JOIN cenc USING (w) "
        "GROUP BY role"))
    bench = train + [f"btoks AS ({toks('benchmark', 'item_id')})",
                     "bw AS (SELECT w, count(*) AS n FROM btoks GROUP BY w)",
                     f"benc AS ({apply_chain('a', 'bw')})"]
    q["token_total_benchmark"] = with_(bench, (
        f"SELECT coalesce(sum(bw.n * len({split_tokens('benc.seq')})), 0)::BIGINT AS n_tokens "
        "FROM bw JOIN benc USING (w)"))
    q["token_offsets"] = with_(doc_enc, (
        "SELECT doc_id, n_tokens, coalesce(sum(n_tokens) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING "
        "AND 1 PRECEDING), 0)::BIGINT AS start_pos FROM denc"))
    q["split_token_totals"] = with_(line_enc, (
        "SELECT CASE WHEN doc_id % 10 = 0 THEN 'val' ELSE 'train' END AS split, sum(n_tokens)::BIGINT AS n_tokens, "
        "count(*)::BIGINT AS n_rows FROM linenc WHERE n_tokens > 0 GROUP BY 1"))
    q["token_total_by_split_rows"] = with_(doc_enc, (
        "SELECT CASE WHEN doc_id % 10 = 0 THEN 'val' ELSE 'train' END AS split, sum(n_tokens)::BIGINT AS n_tokens, "
        "count(*)::BIGINT AS n_rows FROM denc GROUP BY 1"))
    t64 = [f"atoks AS ({toks('documents', 'doc_id')})", f"awords AS ({words_of('atoks')})", *chain("a", "awords", 64),
           merges_cte("a", 64)]
    q["train_merges_64"] = with_(t64, "SELECT rank, left_hex, right_hex FROM amerges")
    q["train_merges_64_delta"] = q["train_merges_64_index"] = q["train_merges_64"]
    q["train_report_64"] = with_([*t64, vocab_cte("a", 64)], (
        "SELECT (SELECT count(*) FROM avocab)::INTEGER AS vocab_size, (SELECT count(*) FROM amerges)::INTEGER AS merges, "
        "true AS fewer_recounts, id AS longest_id, (strlen(hex) // 2)::INTEGER AS longest_bytes, hex AS longest_hex, "
        "(SELECT count(*) FROM awords)::BIGINT AS distinct_words, (SELECT sum(n) FROM awords)::BIGINT AS pretokens "
        "FROM avocab ORDER BY strlen(hex) DESC, id LIMIT 1"))
    talk = train + ["r AS MATERIALIZED (SELECT row_number() OVER () AS rid, conv_id, text FROM conversations)",
                    f"rtoks AS ({toks('r', 'rid')})", "rw AS (SELECT DISTINCT w FROM rtoks)",
                    f"renc AS ({apply_chain('a', 'rw')})"] + encoded_ids("r", "rtoks", "rid", "renc")
    q["encode_conversations_16"] = with_(talk, (
        "SELECT conv_id, count(i.id)::INTEGER AS n_tokens, "
        "coalesce(string_agg(i.id::VARCHAR, ' ' ORDER BY i.seg, i.pos, i.tp), '') AS ids_text "
        "FROM r LEFT JOIN rids i USING (rid) GROUP BY rid, conv_id"))
    q["token_counts_blank_texts"] = with_(doc_enc, (
        "SELECT doc_id % 10 AS m, sum(CASE WHEN doc_id % 10 < 2 THEN 0 ELSE n_tokens END)::BIGINT AS n_tokens "
        "FROM denc GROUP BY 1"))
    many = train + [f"s AS (SELECT doc_id, replace(text, ' ', '{SP}') AS text FROM documents)",
                    f"stoks AS ({toks('s', 'doc_id')})", "sw AS (SELECT DISTINCT w FROM stoks)",
                    f"senc AS (SELECT w, len({split_tokens('seq')}) AS k FROM ({apply_chain('a', 'sw')}))",
                    "sn AS (SELECT doc_id, sum(k) AS k FROM stoks JOIN senc USING (w) GROUP BY doc_id)"]
    q["encode_many_specials"] = with_(many, (
        "SELECT doc_id, (coalesce(k, 0) + length(text) - length(replace(text, ' ', '')))::INTEGER AS n_tokens "
        "FROM documents LEFT JOIN sn USING (doc_id)"))
    q["token_strings_16"] = with_(doc_enc + [f"av AS (SELECT id, {alpha_hex('hex')} AS a FROM avocab)"], (
        "SELECT x.doc_id, coalesce(string_agg(a, ' ' ORDER BY i.seg, i.pos, i.tp), '') AS tokens "
        "FROM documents x LEFT JOIN (dids JOIN av USING (id)) i USING (doc_id) GROUP BY x.doc_id"))
    q["token_offsets_by_lang"] = with_(doc_enc, (
        "SELECT stream, source, doc_id, n_tokens, coalesce(sum(n_tokens) OVER (PARTITION BY stream ORDER BY source, doc_id "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_pos FROM ("
        "SELECT CASE WHEN x.lang <> 'de' THEN x.lang END AS stream, source, doc_id, n_tokens "
        "FROM denc x JOIN documents d USING (doc_id))"))
    q["token_shards_ids"] = with_(line_enc, (
        "SELECT split, (row_number() OVER (PARTITION BY split ORDER BY doc_id, line_no, seg, pos, tp) - 1)::BIGINT AS pos, "
        "id FROM (SELECT *, CASE WHEN doc_id % 10 = 0 THEN 'val' ELSE 'train' END AS split FROM lids)"))
    q["stream_shard_ids"] = q["token_shards_ids"]
    q["stream_split_totals"] = q["split_token_totals"]
    q["token_shards_range"] = f"SELECT * FROM ({q['token_shards_ids']}) WHERE split = 'val' AND pos >= 1000 AND pos < 61000"
    # what is left of the first character's bytes goes; "(" stays from the bytes put before it
    q["decode_invalid_utf8"] = "SELECT doc_id, '(' || substr(text, 2) AS text FROM documents WHERE length(text) > 0"
    q["stream_word_counts_compacted"] = q["pretoken_counts"]
    q["bundle_merges_roundtrip"] = q["train_merges_16"]
    q["train_merges_16_text_files"] = q["train_merges_16"]
    q["text_export_roundtrip"] = q["train_merges_16"]
    q["token_shards_totals"] = with_(line_enc, (
        "SELECT CASE WHEN doc_id % 10 = 0 THEN 'val' ELSE 'train' END AS split, sum(n_tokens)::BIGINT AS n_tokens "
        "FROM linenc GROUP BY 1"))
    q["stream_encode_totals"] = with_(line_enc, "SELECT doc_id, sum(n_tokens)::BIGINT AS n_tokens FROM linenc "
                                                "GROUP BY doc_id")
    q["pretoken_counts_text_ranges"] = q["pretoken_counts"]
    q["stream_word_counts"] = q["pretoken_counts"]
    q["decode_roundtrip"] = "SELECT doc_id, text FROM documents"
    q["decode_skip_specials"] = "SELECT doc_id, replace(text, chr(10), '') AS text FROM documents"
    return q
