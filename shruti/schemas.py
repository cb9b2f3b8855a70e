"""Declared schemas; nothing is inferred."""

from pyspark.sql import types as T

TEXT = "utt_id string, transcript string"
WAV_SCP = "rec_id string, audio_source string"
SEGMENTS = "utt_id string, rec_id string, start_sec double, end_sec double"
UTT2SPK = "utt_id string, spk_id string"
UTT2DUR = "utt_id string, duration double"
AUDIO_INDEX = "basename string, path string"
PAIRS = "stem string, audio_path string, transcript_path string"
CROSSCHECK = "utt_id string, recording_id string, start_sec string, end_sec string, duration_sec string, audio_path string, reference string, hypothesis string, wer string, cer string"
#: As a type, since functions are made of it before any session is there.
HEADER = T.StructType([T.StructField("sample_rate", T.IntegerType()), T.StructField("channels", T.IntegerType()), T.StructField("frames", T.LongType()), T.StructField("sample_width", T.IntegerType()), T.StructField("error", T.StringType())])

#: Output columns, in order.
EVAL_COLUMNS = ["utt_id", "spk_id", "rec_id", "start", "end", "reference", "hypothesis", "ref_normalized", "hyp_normalized", "WER", "CER"]
FOLDER_COLUMNS = ["utterance_id", "audio_path", "reference", "hypothesis", "ref_normalized", "hyp_normalized", "WER", "CER"]
QC_COLUMNS = [
    "utt_id", "pass", "score", "lr_per_frame", "mean_token_score", "min_token_score", "forced_logprob", "greedy_logprob", "snr", "start_time", "end_time", "audio_duration",
    "target_length", "audio_frames", "ref_tokens", "pred_tokens", "error", "text", "audio_path",
]
CROSSCHECK_COLUMNS = [
    "utt_id", "recording_id", "start_sec", "end_sec", "duration_sec", "audio_path", "reference", "hypothesis", "whisper", "wer_orig", "cer_orig", "wjac_whisper_ref", "wjac_whisper_hyp",
    "cjac_whisper_ref", "cjac_whisper_hyp", "category",
]
AUDIT_COLUMNS = [
    "corpus", "split", "layout", "utts_in_text", "segments", "recordings_in_wav_scp", "recordings_resolved", "recordings_path_as_given", "recordings_unresolved", "verifiable_utts", "unique_recordings",
    "unique_monologue_speakers", "unique_stereo_channels", "utts_with_no_speaker_label", "fam_monologue", "fam_stereo_channel", "fam_vendor", "fam_unknown", "hours", "lost_no_segment", "lost_not_in_wav_scp",
    "lost_audio_missing", "lost_empty_transcript", "utt2spk_degenerate", "utt2spk_rows", "band_WB", "band_NB", "band_duplicate_recordings",
]
