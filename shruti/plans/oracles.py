"""DuckDB SQL that gives the rows of the queries, from the general tables alone."""

from __future__ import annotations

from ..functions.signal import FLOOR, WADA_TABLE

WS = r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}-\x{2029}\x{202F}\x{205F}\x{3000}"
#: Letters beyond ASCII in the tables, and characters that normalised text can't have: levenshtein counts bytes here.
WIDE, NARROW = "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß", "ABCDEFGHIJKLMNOPQRSTUVWXYZ!#$%&()"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[{WS}]+'), lambda w: w <> '')"


def norm(x: str) -> str:
    kept = rf"regexp_replace(regexp_replace({strip(f'nfc_normalize({x})')}, '[\x{{964}}\x{{965}}\x{{C3D}}]', '', 'g'), '[^\p{{L}}\p{{N}}_{WS}]', '', 'g')"
    collapsed = f"regexp_replace({kept}, '[{WS}]+', ' ', 'g')"
    return f"lower({strip(collapsed)})"


def char_edits(a: str, b: str) -> str:
    return f"levenshtein(translate({a}, '{WIDE}', '{NARROW}'), translate({b}, '{WIDE}', '{NARROW}'))"


def word_edits(source: str) -> str:
    """ed(utt_id, word_edits) from source(utt_id, rw, hw): a row of the table of distances for each word of the hypothesis; insertions by a running minimum."""
    return f"""rl AS (SELECT utt_id, CAST(unnest(range(1, len(rw) + 1)) AS INTEGER) AS j, hash(unnest(rw)) AS rid FROM {source} UNION ALL SELECT utt_id, 0, 0 FROM {source}),
hl AS (SELECT utt_id, CAST(unnest(range(1, len(hw) + 1)) AS INTEGER) AS i, hash(unnest(hw)) AS hid FROM {source}),
dp(utt_id, i, j, rid, v) AS (SELECT utt_id, 0, j, rid, j FROM rl UNION ALL
    SELECT utt_id, i, j, rid, CAST(j + min(c - j) OVER (PARTITION BY utt_id ORDER BY j) AS INTEGER) FROM (SELECT d.utt_id, h.i, d.j, d.rid,
        CASE WHEN d.j = 0 THEN d.v + 1 ELSE least(d.v + 1, lag(d.v) OVER (PARTITION BY d.utt_id ORDER BY d.j) + CASE WHEN rid = hid THEN 0 ELSE 1 END) END AS c FROM dp d JOIN hl h ON h.utt_id = d.utt_id AND h.i = d.i + 1)),
ed AS (SELECT dp.utt_id, v AS word_edits FROM dp JOIN {source} s ON s.utt_id = dp.utt_id AND dp.i = len(s.hw) AND dp.j = len(s.rw))"""


TRANSCRIPTS = """t AS (SELECT concat_ws('-', c.conv_id, c.turn) AS utt_id, c.role AS split, c.turn, coalesce(c.text, '') AS reference,
    CASE WHEN c.role <> 'system' THEN array_to_string(list_filter(string_split(coalesce(c.text, ''), ' '), lambda w, i: i % 7 <> 0), ' ') END AS hypothesis,
    CASE WHEN n.conv_id IS NOT NULL THEN coalesce(n.text, '') END AS whisper
    FROM conversations c LEFT JOIN conversations n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1)"""

EVALUATED = f"""{TRANSCRIPTS},
n AS (SELECT *, {norm("reference")} AS ref_normalized, {norm("coalesce(hypothesis, '[AUDIO_FAILED]')")} AS hyp_normalized FROM t),
w AS (SELECT *, {words("ref_normalized")} AS rw, {words("hyp_normalized")} AS hw FROM n),
{word_edits("w")},
d AS (SELECT w.*, word_edits, {char_edits("ref_normalized", "hyp_normalized")} AS char_edits FROM w JOIN ed ON ed.utt_id = w.utt_id),
e AS (SELECT *, CASE WHEN ref_normalized = '' AND hyp_normalized = '' THEN 0.0 WHEN ref_normalized = '' THEN -1.0 WHEN hyp_normalized = '' THEN 100.0 ELSE round(100.0::DOUBLE * word_edits / len(rw), 4) END::DOUBLE AS WER,
    CASE WHEN ref_normalized = '' AND hyp_normalized = '' THEN 0.0 WHEN ref_normalized = '' THEN -1.0 WHEN hyp_normalized = '' THEN 100.0 ELSE round(100.0::DOUBLE * char_edits / length(ref_normalized), 4) END::DOUBLE AS CER FROM d)"""


def summary(lost: str) -> str:
    return f"""{EVALUATED},
k AS (SELECT *, ref_normalized <> '' AND WER >= 0 AND NOT {lost} AS kept FROM e),
s AS (SELECT split, count(*) FILTER (kept) AS n, count(*) FILTER (NOT kept) AS n_skipped,
    coalesce(round(avg(WER) FILTER (kept), 4), 0.0) AS avg_wer, coalesce(round(avg(CER) FILTER (kept), 4), 0.0) AS avg_cer,
    coalesce(round(100.0::DOUBLE * sum(word_edits) FILTER (kept) / sum(len(rw)) FILTER (kept), 4), 0.0) AS corpus_wer,
    coalesce(round(100.0::DOUBLE * sum(char_edits) FILTER (kept) / sum(length(ref_normalized)) FILTER (kept), 4), 0.0) AS corpus_cer FROM k GROUP BY split)"""


SUMMARY = summary("regexp_matches(coalesce(hypothesis, '[AUDIO_FAILED]'), '\\[(AUDIO|INFERENCE)_FAILED\\]')")
COMPAT = summary("regexp_matches(hyp_normalized, '\\[(AUDIO|INFERENCE)_FAILED\\]')")


def jaccard(a: str, b: str) -> str:
    union = f"len(list_distinct(list_concat({a}, {b})))"
    return f"CASE WHEN {union} = 0 THEN 1.0 ELSE len(list_intersect(list_distinct({a}), list_distinct({b})))::DOUBLE / {union} END"


CHECKED = f"""{TRANSCRIPTS},
l AS (SELECT *, {words("coalesce(whisper, '')")} AS w3, {words("reference")} AS wr, {words("coalesce(hypothesis, '')")} AS wh,
    list_filter(string_split(replace(coalesce(whisper, ''), ' ', ''), ''), lambda x: x <> '') AS c3, list_filter(string_split(replace(reference, ' ', ''), ''), lambda x: x <> '') AS cr,
    list_filter(string_split(replace(coalesce(hypothesis, ''), ' ', ''), ''), lambda x: x <> '') AS ch FROM t),
j AS (SELECT *, {jaccard("w3", "wr")} AS a, {jaccard("w3", "wh")} AS b, {jaccard("c3", "cr")} AS c, {jaccard("c3", "ch")} AS d FROM l),
x AS (SELECT utt_id, hypothesis IS NULL AS lost, a, b, c, d, CASE WHEN hypothesis IS NULL THEN 'AUDIO_ERROR' WHEN whisper IS NULL OR {strip("whisper")} = '' OR lower({strip("whisper")}) = 'nan' THEN 'WHISPER_SILENT'
    WHEN a >= 0.5 AND b >= 0.5 THEN 'AGREE_BOTH' WHEN a >= 0.5 AND b < 0.3 THEN 'AGREE_REF_ONLY' WHEN b >= 0.5 AND a < 0.3 THEN 'AGREE_HYP_ONLY'
    WHEN c < 0.3 AND d < 0.3 THEN 'DISAGREE_BOTH_STRONG' WHEN a < 0.3 AND b < 0.3 THEN 'DISAGREE_BOTH' ELSE 'PARTIAL_MATCH' END AS category FROM j)"""

DOCUMENT_LINES = r"""r AS (SELECT CAST(doc_id AS VARCHAR) AS source, regexp_split_to_array(coalesce(text, ''), '\r\n|\r|\n') AS ls FROM documents),
lines AS (SELECT source, CAST(unnest(range(0, len(ls))) AS INTEGER) AS line_no, unnest(ls) AS line FROM r)"""
SEGMENT_LINES = """lines AS (SELECT CAST(conv_id AS VARCHAR) AS source, CAST(turn AS INTEGER) AS line_no,
    concat_ws('-', conv_id, turn // 2) || '  rec' || conv_id || ' ' || CAST((turn * 2 + 0.5)::DOUBLE AS VARCHAR) || CASE WHEN role = 'user' THEN ' ' || CAST((turn * 2 + 1.5)::DOUBLE AS VARCHAR) ELSE '' END AS line FROM conversations)"""
DURATION_LINES = """lines AS (SELECT CAST(conv_id AS VARCHAR) AS source, CAST(turn AS INTEGER) AS line_no,
    'u' || (turn // 3) || ' ' || CASE WHEN role = 'user' THEN CAST(length(text) / 16.0::DOUBLE AS VARCHAR) ELSE role END AS line FROM conversations)"""


def two_column(source: str, key: str, value: str, need_value: bool = False) -> str:
    return rf"""{source},
s AS (SELECT source, line_no, {strip("line")} AS line FROM lines),
h AS (SELECT *, regexp_extract(line, '^[^{WS}]+') AS key FROM s WHERE line <> ''),
v AS (SELECT source, line_no, key, {strip("substr(line, length(key) + 1)")} AS value FROM h),
f AS (SELECT source, key AS {key}, arg_max(value, line_no) AS {value}, min(line_no) AS line_no FROM v {"WHERE value <> ''" if need_value else ""} GROUP BY source, key)"""


CORPUS = "CASE WHEN o_orderstatus = 'P' THEN 'corpus_F_cleaned' ELSE 'corpus_' || o_orderstatus END"
BASE = """CASE WHEN c_nationkey < 8 THEN (c_custkey // 2) || '_Nagpur_' || CASE WHEN c_acctbal > 4000 THEN 'M' ELSE 'F' END || '_' || c_nationkey || '_monologue_' || (c_custkey // 2)
    WHEN c_nationkey < 14 THEN 'bn_IN_' || c_nationkey || '_' || (c_custkey // 2) || '_Left' WHEN c_nationkey < 20 THEN 'be_SHA1P_C2_r' || (c_custkey // 2) || '_s002' ELSE 'x' || (c_custkey // 2) END"""
ENTRY = """CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN '/data/' || rec_id || '.wav' WHEN c_mktsegment = 'BUILDING' THEN rec_id || '.wav'
    WHEN c_mktsegment = 'MACHINERY' THEN 'sox ' || rec_id || '.wav -t wav - |' ELSE '/old//place/' || rec_id || '.wav' END"""
CORPORA = f"""cust AS (SELECT *, {BASE} || CASE WHEN c_acctbal > 7000 THEN '_WB' WHEN c_acctbal > 3000 THEN '_NB' ELSE '' END AS rec_id FROM customer),
txt AS (SELECT {CORPUS} AS corpus, o_orderpriority AS split, CAST(o_orderkey AS VARCHAR) AS utt_id, CASE WHEN o_totalprice < 30000 THEN '  ' ELSE o_orderpriority END AS transcript FROM orders),
one AS (SELECT l_orderkey, arg_max({{'d': l_discount, 'q': l_quantity}}, {{'a': l_partkey, 'b': l_suppkey, 'c': l_shipdate, 'd': l_extendedprice}}) AS v FROM lineitem WHERE l_linenumber = 1 GROUP BY l_orderkey),
seg AS (SELECT {CORPUS} AS corpus, o_orderpriority AS split, CAST(o_orderkey AS VARCHAR) AS utt_id, rec_id, v.d AS start_sec, v.d + v.q - 3 AS end_sec
    FROM one JOIN orders ON o_orderkey = l_orderkey JOIN cust ON c_custkey = o_custkey WHERE o_orderpriority <> '5-LOW'),
wav0 AS (SELECT {CORPUS} AS corpus, o_orderpriority AS split, c_mktsegment, CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_orderkey AS VARCHAR) ELSE rec_id END AS rec_id FROM orders JOIN cust ON c_custkey = o_custkey WHERE c_acctbal >= 0),
wav AS (SELECT corpus, split, rec_id, max({ENTRY}) AS audio_source FROM wav0 GROUP BY ALL),
allwav AS (SELECT rec_id, max({ENTRY}) AS audio_source FROM cust WHERE c_acctbal >= 0 GROUP BY rec_id),
spk AS (SELECT {CORPUS} AS corpus, o_orderpriority AS split, CAST(o_orderkey AS VARCHAR) AS utt_id, CASE WHEN o_totalprice > 150000 THEN CAST(o_orderkey AS VARCHAR) ELSE 'c' || o_custkey END AS spk_id
    FROM orders WHERE o_orderstatus <> 'P' OR o_totalprice > 60000),
dur AS (SELECT {CORPUS} AS corpus, o_orderpriority AS split, CAST(o_orderkey AS VARCHAR) AS utt_id, floor(o_totalprice) / 1000 AS duration FROM orders WHERE o_totalprice < 250000)"""
LOCATED = f"""{CORPORA},
loc AS (SELECT txt.utt_id, seg.rec_id, start_sec AS start, end_sec AS "end", transcript, audio_source,
    CASE WHEN seg.utt_id IS NULL THEN 'no_segment' WHEN allwav.rec_id IS NULL THEN 'recording_missing' END AS reason FROM txt LEFT JOIN seg ON seg.utt_id = txt.utt_id LEFT JOIN allwav ON allwav.rec_id = seg.rec_id)"""
RESOLVED = f"""{CORPORA},
there AS (SELECT DISTINCT '/data/' || rec_id || '.wav' AS path FROM cust WHERE c_nationkey < 20),
names AS (SELECT rec_id || '.wav' AS basename FROM cust WHERE c_mktsegment <> 'FURNITURE' UNION ALL SELECT o_orderkey || '.wav' FROM orders WHERE o_orderpriority = '5-LOW' AND o_totalprice > 100000),
idx AS (SELECT DISTINCT corpus, basename, '/audio/' || replace(corpus, '_cleaned', '') || '/' || basename AS path FROM names, (VALUES ('corpus_F'), ('corpus_O'), ('corpus_F_cleaned')) x(corpus)),
cand AS (SELECT *, coalesce(({words("audio_source")})[1], '') AS cand, {strip("audio_source")} LIKE '%|' AS is_pipe FROM wav),
res AS (SELECT cand.corpus, cand.split, cand.rec_id, audio_source, is_pipe, there.path IS NOT NULL AND cand <> '' AND cand NOT LIKE '%|' AS given, cand, coalesce(a.path, b.path) AS found FROM cand LEFT JOIN there ON there.path = cand
    LEFT JOIN idx a ON a.corpus = cand.corpus AND a.basename = CASE WHEN cand <> '' THEN regexp_extract(cand, '[^/]*$') ELSE rec_id || '.wav' END LEFT JOIN idx b ON b.corpus = cand.corpus AND b.basename = rec_id || '.wav'),
resolved AS (SELECT corpus, split, rec_id, audio_source, is_pipe, CASE WHEN given THEN cand ELSE found END AS path, CASE WHEN given THEN 'as_given' WHEN found IS NOT NULL THEN 'by_name' ELSE 'unresolved' END AS resolution FROM res)"""
MONO, STEREO, VENDOR = r"^(\d+)_([A-Za-z]+)_([A-Z]{1,2})_(\d+)_", r"^([a-z]{2})_IN_(\d+)_(\d+)_(Left|Right)$", r"^([a-z]{2})_([A-Za-z0-9]+)_([A-Z]+\d*)_r(\d+)_[sS](\d+)$"
FAMILY = f"CASE WHEN regexp_matches(base, '{MONO}') THEN 'monologue' WHEN regexp_matches(base, '{STEREO}') THEN 'stereo_channel' WHEN regexp_matches(base, '{VENDOR}') THEN 'vendor' ELSE 'unknown' END"
SPEAKER = f"CASE WHEN regexp_matches(base, '{MONO}') THEN concat_ws('_', " + ", ".join(f"regexp_extract(base, '{MONO}', {i})" for i in range(1, 5)) + f") WHEN regexp_matches(base, '{STEREO}') THEN base END"
WATERFALL = f"""{RESOLVED},
lay AS (SELECT DISTINCT corpus, split FROM seg),
w0 AS (SELECT txt.*, lay.corpus IS NOT NULL AS segmented, CASE WHEN lay.corpus IS NOT NULL THEN seg.rec_id ELSE txt.utt_id END AS rec_id, start_sec, end_sec
    FROM txt LEFT JOIN lay ON lay.corpus = txt.corpus AND lay.split = txt.split LEFT JOIN seg ON seg.corpus = txt.corpus AND seg.split = txt.split AND seg.utt_id = txt.utt_id),
wf AS (SELECT w0.*, resolution, CASE WHEN w0.rec_id IS NULL THEN 'no_segment' WHEN resolution IS NULL THEN 'not_in_wav_scp' WHEN resolution = 'unresolved' THEN 'audio_missing' WHEN {strip("transcript")} = '' THEN 'empty_transcript' END AS reason,
    regexp_replace(w0.rec_id, '_(WB|NB)$', '') AS base FROM w0 LEFT JOIN resolved ON resolved.corpus = w0.corpus AND resolved.split = w0.split AND resolved.rec_id = w0.rec_id),
wc AS (SELECT *, {FAMILY} AS family, {SPEAKER} AS speaker, reason IS NULL AS ok FROM wf)"""
REPORT = f"""{WATERFALL},
u AS (SELECT wc.corpus, wc.split, max(CASE WHEN segmented THEN 'segmented' ELSE 'one-file-per-utterance' END) AS layout, count(*) AS utts_in_text, count(*) FILTER (ok) AS verifiable_utts,
    count(DISTINCT base) FILTER (ok) AS unique_recordings, count(DISTINCT speaker) FILTER (ok AND family = 'monologue') AS unique_monologue_speakers, count(DISTINCT speaker) FILTER (ok AND family = 'stereo_channel') AS unique_stereo_channels,
    count(*) FILTER (ok AND family IN ('vendor', 'unknown')) AS utts_with_no_speaker_label, count(*) FILTER (ok AND family = 'monologue') AS fam_monologue, count(*) FILTER (ok AND family = 'stereo_channel') AS fam_stereo_channel,
    count(*) FILTER (ok AND family = 'vendor') AS fam_vendor, count(*) FILTER (ok AND family = 'unknown') AS fam_unknown,
    round(coalesce(sum(CASE WHEN segmented THEN greatest(0.0, end_sec - start_sec) ELSE coalesce(duration, 0.0) END) FILTER (ok), 0.0) / 3600, 2) AS hours,
    count(*) FILTER (reason = 'no_segment') AS lost_no_segment, count(*) FILTER (reason = 'not_in_wav_scp') AS lost_not_in_wav_scp, count(*) FILTER (reason = 'audio_missing') AS lost_audio_missing, count(*) FILTER (reason = 'empty_transcript') AS lost_empty_transcript
    FROM wc LEFT JOIN dur ON dur.corpus = wc.corpus AND dur.split = wc.split AND dur.utt_id = wc.utt_id GROUP BY ALL),
g AS (SELECT corpus, split, count(*) AS segments FROM seg GROUP BY ALL),
rc AS (SELECT corpus, split, count(*) AS recordings_in_wav_scp, count(*) FILTER (resolution <> 'unresolved') AS recordings_resolved, count(*) FILTER (resolution = 'as_given') AS recordings_path_as_given,
    count(*) FILTER (resolution = 'unresolved') AS recordings_unresolved, count(*) FILTER (rec_id LIKE '%\\_WB' ESCAPE '\\') AS band_WB, count(*) FILTER (rec_id LIKE '%\\_NB' ESCAPE '\\') AS band_NB,
    count(*) - count(DISTINCT regexp_replace(rec_id, '_(WB|NB)$', '')) AS band_duplicate_recordings FROM resolved GROUP BY ALL),
sc AS (SELECT corpus, split, count(*) FILTER (utt_id = spk_id) AS utt2spk_degenerate, count(*) AS utt2spk_rows FROM spk GROUP BY ALL),
report AS (SELECT u.corpus, u.split, layout, utts_in_text, coalesce(segments, 0) AS segments, coalesce(recordings_in_wav_scp, 0) AS recordings_in_wav_scp, coalesce(recordings_resolved, 0) AS recordings_resolved,
    coalesce(recordings_path_as_given, 0) AS recordings_path_as_given, coalesce(recordings_unresolved, 0) AS recordings_unresolved, verifiable_utts, unique_recordings, unique_monologue_speakers, unique_stereo_channels,
    utts_with_no_speaker_label, fam_monologue, fam_stereo_channel, fam_vendor, fam_unknown, hours, lost_no_segment, lost_not_in_wav_scp, lost_audio_missing, lost_empty_transcript,
    coalesce(utt2spk_degenerate, 0) AS utt2spk_degenerate, coalesce(utt2spk_rows, 0) AS utt2spk_rows, coalesce(band_WB, 0) AS band_WB, coalesce(band_NB, 0) AS band_NB, coalesce(band_duplicate_recordings, 0) AS band_duplicate_recordings
    FROM u LEFT JOIN g USING (corpus, split) LEFT JOIN rc USING (corpus, split) LEFT JOIN sc USING (corpus, split))"""

PAIRS = """a AS (SELECT 'd.' || doc_id AS stem, '/c/audio_16k/d.' || doc_id || '.wav' AS audio_path FROM documents WHERE lang <> 'es'),
b AS (SELECT 'd.' || doc_id AS stem, '/c/transcripts/d.' || doc_id || '.txt' AS transcript_path FROM labels)"""

TABLE = "[" + ", ".join(map(str, WADA_TABLE)) + "]::DOUBLE[]"
LEVEL = f"""v AS (SELECT vec_id, list_transform(embedding, lambda x: greatest(abs(x::DOUBLE), {FLOOR}::DOUBLE)) AS a, embedding FROM embeddings),
lv AS (SELECT vec_id, ln(list_sum(a) / len(a)) - list_sum(list_transform(a, lambda x: ln(x))) / len(a) AS v3, {TABLE} AS g FROM v),
li AS (SELECT *, len(list_filter(g, lambda y: y < v3)) AS below FROM lv),
snr AS (SELECT vec_id, v3, CASE WHEN v3 <= g[1] THEN -20.0 WHEN v3 >= g[121] THEN 100.0 ELSE -20 + (below - 1) + (v3 - g[below]) / (g[below + 1] - g[below]) END AS snr FROM li)"""


def softmax(f: str) -> str:
    return f"list_transform({f}, lambda x: x - list_max({f}) - ln(list_sum(list_transform({f}, lambda y: exp(y - list_max({f}))))))"


FRAMES = f"""raw AS (SELECT vec_id, label, list_transform(range(0, 8), lambda t: list_transform(embedding[t * 8 + 1:t * 8 + 8], lambda x: x::DOUBLE * 4)) AS f,
    ([vec_id % 7, (vec_id // 7) % 7, label % 7, (vec_id // 49) % 7])[1:label % 5] AS ids FROM embeddings),
fr AS (SELECT vec_id, list_transform(f, lambda g: {softmax("g")}) AS f, CASE WHEN label = 8 THEN list_append(ids, 7) WHEN label = 9 THEN [1, 1, 1, 1, 1, 1] ELSE ids END AS target FROM raw)"""
BEST = "list_transform(f, lambda g: list_position(g, list_max(g)) - 1)"
SCORED = f"""{FRAMES},
er AS (SELECT *, len(target) AS n, list_filter(target, lambda x: x < 0 OR x >= 8 OR x = 7) AS wrong, len(target) + len(list_filter(range(2, len(target) + 1), lambda i: target[i] = target[i - 1])) AS need FROM fr),
er2 AS (SELECT *, CASE WHEN n = 0 THEN 'empty target' WHEN len(wrong) > 0 THEN 'invalid ids: ' || array_to_string(wrong[1:5], ',') WHEN 8 < need THEN 'too few frames: 8 < ' || need ELSE '' END AS error,
    list_concat(flatten(list_transform(target, lambda k: [7, k])), [7]) AS z FROM er),
fo AS (SELECT vec_id, n, error, list_sum(list_transform(f, lambda g: list_max(g))) AS greedy, CASE WHEN error = '' THEN list_reduce(list_concat([list_transform(range(1, len(z) + 1), lambda i: CASE WHEN i <= 2 THEN f[1][z[i] + 1] ELSE -1e30 END)], f[2:8]),
    lambda p, g: list_transform(range(1, len(z) + 1), lambda i: g[z[i] + 1] + greatest(p[i], CASE WHEN i > 1 THEN p[i - 1] ELSE -1e30 END, CASE WHEN i > 2 AND z[i] <> 7 AND z[i] <> z[i - 2] THEN p[i - 2] ELSE -1e30 END))) END AS last FROM er2),
sc AS (SELECT vec_id, error, CASE WHEN error = '' THEN greatest(last[-1], last[-2]) ELSE -99.0 END AS forced_logprob, CASE WHEN error = '' THEN greedy ELSE -99.0 END AS greedy_logprob, n FROM fo),
scored AS (SELECT vec_id, error, forced_logprob, greedy_logprob, CASE WHEN error = '' THEN (forced_logprob - greedy_logprob) / n ELSE -99.0 END AS score, CASE WHEN error = '' THEN (forced_logprob - greedy_logprob) / 8 ELSE -99.0 END AS lr_per_frame FROM sc)"""


def shares(c: str, name: str) -> str:
    return f"round(avg({c}), 4) AS {name}_mean, round(quantile_cont({c}, 0.1), 4) AS {name}_p10, round(quantile_cont({c}, 0.5), 4) AS {name}_median, round(quantile_cont({c}, 0.9), 4) AS {name}_p90"


def oracle_sql() -> dict[str, str]:
    return {
        "normalize_text": f"SELECT doc_id, {norm("coalesce(text, '')")} AS normalized FROM documents",
        "utt_wer_cer": f"WITH RECURSIVE {EVALUATED} SELECT utt_id, ref_normalized, hyp_normalized, WER, CER FROM e",
        "corpus_wer_cer": f"WITH RECURSIVE {SUMMARY} SELECT * FROM s",
        "corpus_wer_cer_compat": f"WITH RECURSIVE {COMPAT} SELECT * FROM s",
        "word_edit_distance": f"WITH RECURSIVE {TRANSCRIPTS}, w AS (SELECT utt_id, {words('reference')} AS rw, {words("coalesce(whisper, '')")} AS hw FROM t), {word_edits('w')} SELECT utt_id, CAST(word_edits AS BIGINT) AS word_edits, CAST(len(rw) AS BIGINT) AS ref_words FROM w JOIN ed USING (utt_id)",
        "summary_text": f"WITH RECURSIVE {SUMMARY} SELECT concat_ws(' ', rpad(split, 8, ' '), lpad(format('{{:,}}', n), 12, ' '), lpad(printf('%.2f%%', corpus_wer), 12, ' '), lpad(printf('%.2f%%', corpus_cer), 12, ' '), lpad(printf('%.2f%%', avg_wer), 13, ' ')) AS line FROM s",
        "jaccard_categories": f"WITH {CHECKED} SELECT utt_id, CASE WHEN lost THEN 0.0 ELSE round(a, 4) END AS wjac_whisper_ref, CASE WHEN lost THEN 0.0 ELSE round(b, 4) END AS wjac_whisper_hyp, CASE WHEN lost THEN 0.0 ELSE round(c, 4) END AS cjac_whisper_ref, CASE WHEN lost THEN 0.0 ELSE round(d, 4) END AS cjac_whisper_hyp, category FROM x",
        "category_histogram": f"WITH {CHECKED} SELECT category, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM x), 4) AS percent FROM x GROUP BY category",
        "flagged_rows": f"WITH {CHECKED} SELECT utt_id, category FROM x WHERE category IN ('AGREE_HYP_ONLY', 'DISAGREE_BOTH', 'DISAGREE_BOTH_STRONG')",
        "kaldi_text": f"WITH {two_column(DOCUMENT_LINES, 'utt_id', 'transcript')} SELECT * FROM f",
        "kaldi_wav_scp": f"WITH {two_column(DOCUMENT_LINES, 'rec_id', 'audio_source', True)} SELECT source, rec_id, audio_source, {strip('audio_source')} LIKE '%|' AS is_pipe FROM f",
        "kaldi_utt2spk": f"WITH {DOCUMENT_LINES}, p AS (SELECT source, line_no, {words('line')} AS p FROM lines) SELECT source, p[1] AS utt_id, arg_max(p[2], line_no) AS spk_id, min(line_no) AS line_no FROM p WHERE len(p) >= 2 GROUP BY source, p[1]",
        "kaldi_segments": f"WITH {SEGMENT_LINES}, p AS (SELECT source, line_no, {words('line')} AS p FROM lines) SELECT source, p[1] AS utt_id, arg_max(p[2], line_no) AS rec_id, CAST(arg_max(p[3], line_no) AS DOUBLE) AS start_sec, CAST(arg_max(p[4], line_no) AS DOUBLE) AS end_sec, min(line_no) AS line_no FROM p WHERE len(p) = 4 GROUP BY source, p[1]",
        "malformed_segments": f"WITH {SEGMENT_LINES} SELECT source, line_no, line FROM lines WHERE len({words('line')}) NOT IN (0, 4)",
        "kaldi_utt2dur": f"WITH {two_column(DURATION_LINES, 'utt_id', 'd')} SELECT source, utt_id, TRY_CAST(d AS DOUBLE) AS duration FROM f WHERE TRY_CAST(d AS DOUBLE) IS NOT NULL",
        "segment_join": f'WITH {LOCATED} SELECT loc.utt_id, coalesce(spk_id, \'unknown\') AS spk_id, rec_id, start, "end", transcript, audio_source FROM loc LEFT JOIN spk ON spk.utt_id = loc.utt_id WHERE reason IS NULL',
        "unsegmented_join": f"WITH {CORPORA} SELECT utt_id, utt_id AS rec_id, CAST(NULL AS DOUBLE) AS start, CAST(NULL AS DOUBLE) AS \"end\", CASE WHEN wav.rec_id IS NULL THEN 'recording_missing' END AS reason FROM txt LEFT JOIN wav ON wav.rec_id = txt.utt_id",
        "missing_rows": f"WITH {LOCATED} SELECT utt_id, rec_id, reason FROM loc WHERE reason IS NOT NULL",
        "join_losses": f"WITH {LOCATED} SELECT reason, count(*) AS n FROM loc WHERE reason IS NOT NULL GROUP BY reason",
        "pair_match": f"WITH {PAIRS} SELECT stem, audio_path, transcript_path FROM a JOIN b USING (stem)",
        "pair_no_transcript": f"WITH {PAIRS} SELECT stem, audio_path FROM a ANTI JOIN b USING (stem)",
        "pair_no_audio": f"WITH {PAIRS} SELECT stem, transcript_path FROM b ANTI JOIN a USING (stem)",
        "manifest": f"WITH {CORPORA} SELECT CASE WHEN trim(coalesce(audio_source, '')) LIKE '%|' THEN '' ELSE trim(coalesce(audio_source, '')) END AS audio_filepath, transcript AS text, txt.utt_id, round(coalesce(end_sec - start_sec, 0.0), 3) + 0.0 AS duration, start_sec AS offset FROM txt LEFT JOIN seg ON seg.utt_id = txt.utt_id LEFT JOIN allwav ON allwav.rec_id = coalesce(seg.rec_id, txt.utt_id)",
        "classify_recordings": f"WITH {CORPORA}, b AS (SELECT *, regexp_replace(rec_id, '_(WB|NB)$', '') AS base FROM cust) SELECT c_custkey, rec_id, {FAMILY} AS family, {SPEAKER} AS speaker, base, nullif(regexp_extract(rec_id, '_(WB|NB)$', 1), '') AS band FROM b",
        "path_resolution": f"WITH {RESOLVED} SELECT corpus, split, rec_id, audio_source, is_pipe, path, resolution FROM resolved",
        "page_names": r"WITH p AS (SELECT regexp_replace(url, '\?.*$', '') AS path FROM pages) SELECT regexp_extract(path, '[^/]*$') AS basename, min(path) AS path, count(*) AS n FROM p GROUP BY 1",
        "audit_waterfall": f"WITH {WATERFALL} SELECT corpus, split, utt_id, rec_id, resolution, reason, segmented FROM wc",
        "audit_report": f"WITH {REPORT} SELECT * FROM report",
        "audit_totals": f"WITH {REPORT} SELECT count(*) AS splits, CAST(coalesce(sum(verifiable_utts), 0) AS BIGINT) AS verifiable_utts, round(coalesce(sum(hours), 0.0), 2) AS hours FROM report WHERE NOT regexp_matches(corpus, '_(cleaned|final)$')",
        "audit_across_splits": f"WITH {WATERFALL} SELECT corpus, split, count(DISTINCT base) AS unique_recordings, count(DISTINCT speaker) AS unique_speakers, count(*) AS utterances FROM wc WHERE ok GROUP BY ROLLUP (corpus, split)",
        "audit_demographics": f"WITH {WATERFALL}, p AS (SELECT DISTINCT speaker, regexp_extract(base, '{MONO}', 2) AS city, regexp_extract(base, '{MONO}', 3) AS gender, CAST(regexp_extract(base, '{MONO}', 4) AS INTEGER) AS age FROM wc WHERE ok AND family = 'monologue') SELECT city, gender, count(*) AS speakers, round(avg(age), 4) AS mean_age FROM p GROUP BY city, gender",
        "wada_snr": f"WITH {LEVEL} SELECT vec_id, round(v3, 4) AS statistic, round(snr, 4) AS snr FROM snr",
        "segment_frames": "WITH s AS (SELECT *, l_discount * 100 AS a, l_discount * 100 + l_quantity + l_tax * 10 - 2 AS b FROM lineitem), o AS (SELECT *, CAST(trunc(a) AS BIGINT) AS off FROM s), f AS (SELECT *, greatest(CAST(trunc(b) AS BIGINT) - off, 1) AS n1, greatest(CAST(trunc(b - off) AS BIGINT), 0) AS n2, greatest(CAST(trunc(b) AS BIGINT) - off, 0) AS n3 FROM o) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, least(n1, 64 - off) AS offset_first, least(n2, 64 - off) AS joint, least(n3, 64 - off) AS ends FROM f",
        "unit_scale": "WITH w AS (SELECT vec_id, embedding AS q, list_transform(embedding, lambda x: x * 30000::FLOAT) AS l FROM embeddings), s AS (SELECT vec_id, q, l, CASE WHEN list_max(list_transform(q, lambda x: abs(x))) > 1 THEN 32768.0 ELSE 1.0 END AS dq, CASE WHEN list_max(list_transform(l, lambda x: abs(x))) > 1 THEN 32768.0 ELSE 1.0 END AS dl FROM w) SELECT vec_id, round(list_max(list_transform(q, lambda x: abs(x::DOUBLE / dq::DOUBLE))), 4) AS quiet_peak, round(list_max(list_transform(l, lambda x: abs(x::DOUBLE / dl::DOUBLE))), 4) AS loud_peak, round(list_sum(list_transform(range(1, len(q) + 1), lambda i: (q[i]::DOUBLE + l[i]::DOUBLE) / 2)), 0) AS mono_sum FROM s",
        "log_softmax_slice": f"WITH {FRAMES}, u AS (SELECT vec_id, unnest(range(0, 8)) AS t, unnest(f) AS g FROM fr), x AS (SELECT vec_id, t, [g[3], g[4], g[5], g[8]] AS h FROM u), y AS (SELECT vec_id, t, {softmax('h')} AS z FROM x) SELECT vec_id, t, round(z[1], 4) AS c0, round(z[2], 4) AS c1, round(z[3], 4) AS c2, round(z[4], 4) AS c3 FROM y",
        "ctc_greedy": f"WITH {FRAMES}, b AS (SELECT vec_id, f, {BEST} AS b FROM fr) SELECT vec_id, array_to_string(list_transform(list_filter(range(1, 9), lambda i: b[i] <> 7 AND (i = 1 OR b[i] <> b[i - 1])), lambda i: b[i]), ' ') AS ids, round(list_sum(list_transform(f, lambda g: list_max(g))), 4) AS greedy_logprob FROM b",
        "forced_score": f"WITH {SCORED} SELECT vec_id, error, round(forced_logprob, 4) AS forced_logprob, round(greedy_logprob, 4) AS greedy_logprob, round(score, 4) AS score, round(lr_per_frame, 4) AS lr_per_frame FROM scored",
        "qc_pass": f"WITH {SCORED} SELECT vec_id, round(score, 4) AS score, error = '' AND score >= -1.5 AS pass FROM scored",
        "qc_summary": f"WITH {SCORED}, {LEVEL}, j AS (SELECT error = '' AND score >= -1.5 AS pass, CASE WHEN error = '' THEN score END AS s, snr FROM scored JOIN snr USING (vec_id)) SELECT count(*) AS total, count(*) FILTER (pass) AS accepted, count(*) FILTER (NOT pass) AS rejected, round(100.0::DOUBLE * count(*) FILTER (pass) / count(*), 4) AS accepted_percent, round(100.0::DOUBLE * count(*) FILTER (NOT pass) / count(*), 4) AS rejected_percent, {shares('s', 'score')}, {shares('snr', 'snr')} FROM j",
        "resample_audio": "SELECT CAST(vec_id AS VARCHAR) AS path, 8000 AS sample_rate, 1 AS channels, CAST(len(embedding) AS BIGINT) AS frames, TRUE AS needs_conversion, 'converted' AS status, round(2 * len(embedding) / 16000.0::DOUBLE, 4) AS seconds FROM embeddings",
        "output_paths": "WITH p AS (SELECT DISTINCT p_type, p_brand, p_size > 25 AS big FROM part) SELECT '/out/' || p_type || '/' || p_brand || '.wav' AS out, count(*) AS n FROM p GROUP BY 1 HAVING count(*) > 1",
        "chunk_assignment": "WITH p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders) SELECT o_orderkey, CAST(least(pos // (n // least(4, n)), least(4, n) - 1) AS INTEGER) AS chunk FROM p",
        "rate_histogram": "WITH f AS (SELECT p_size * 1000 AS rate FROM part ORDER BY concat_ws('/', p_brand, p_name, CAST(p_partkey AS VARCHAR)) LIMIT 10) SELECT rate, count(*) AS n, CAST(count(*) FILTER (rate <> 16000) AS BIGINT) AS to_convert FROM f GROUP BY rate",
    }
