"""Names, prompt slots and the WAV header (SCL18, SCL20, SCL21, PRJ3 bytes)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default prompt slots of the fine-tuning config.
PROMPT_DEFAULTS = {
    "decodercontext": "",
    "source_lang": "<|ru|>",
    "target_lang": "<|ru|>",
    "emotion": "<|emo:undefined|>",
    "pnc": "<|pnc|>",
    "itn": "<|noitn|>",
    "diarize": "<|nodiarize|>",
    "timestamp": "<|notimestamp|>",
}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def prompt_slots(row_slots: Column, defaults: dict | None = None) -> Column:
    """SCL18: defaults overlaid by the row's own (non-null) slots."""
    d = defaults or PROMPT_DEFAULTS
    base = F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])
    row = F.map_filter(F.coalesce(row_slots, F.create_map().cast("map<string,string>")),
                       lambda k, v: v.isNotNull())
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(row, k)), row)


def experiment_name(aggregation, exclude_blank, include_duration, method, alpha,
                    entropy_type=None, entropy_norm=None) -> Column:
    """SCL20: ``aggregation-(no_)blank-(no_)duration-method[-type-norm]-alpha``."""
    blank = F.when(_c(exclude_blank), F.lit("no_blank")).otherwise(F.lit("blank"))
    dur = F.when(_c(include_duration), F.lit("duration")).otherwise(F.lit("no_duration"))
    a = _c(alpha).cast("string")
    ent = _c(method) == "entropy"
    et = _c(entropy_type) if entropy_type is not None else F.lit(None).cast("string")
    en = _c(entropy_norm) if entropy_norm is not None else F.lit(None).cast("string")
    return F.when(ent, F.concat_ws("-", _c(aggregation), blank, dur, _c(method), et, en, a)) \
        .otherwise(F.concat_ws("-", _c(aggregation), blank, dur, _c(method), a))


def experiment_params(aggregation, exclude_blank, include_duration, method, alpha,
                      entropy_type=None, entropy_norm=None) -> Column:
    """SCL20: the parameter list; non-entropy methods get '-' for type and norm."""
    ent = _c(method) == "entropy"
    et = _c(entropy_type) if entropy_type is not None else F.lit(None).cast("string")
    en = _c(entropy_norm) if entropy_norm is not None else F.lit(None).cast("string")
    return F.array(_c(aggregation),
                   F.when(_c(exclude_blank), "True").otherwise("False"),
                   F.when(_c(include_duration), "True").otherwise("False"),
                   _c(method),
                   F.when(ent, et).otherwise(F.lit("-")),
                   F.when(ent, en).otherwise(F.lit("-")),
                   _c(alpha).cast("string"))


def vocab_name(tokenizer_type, spe_type, vocab_size, max_len, pad, bos, eos) -> Column:
    """SCL21: ``tokenizer_{type}_{spe_type}_v{N}[_max_L][_pad][_bos][_eos]``; the
    ``max`` part only when the maximum piece length is positive."""
    base = F.concat(F.lit("tokenizer_"), _c(tokenizer_type), F.lit("_"), _c(spe_type),
                    F.lit("_v"), _c(vocab_size).cast("string"))
    base = F.when(_c(max_len) > 0, F.concat(base, F.lit("_max_"), _c(max_len).cast("string"))) \
        .otherwise(base)
    for flag, suffix in ((pad, "_pad"), (bos, "_bos"), (eos, "_eos")):
        base = F.when(_c(flag), F.concat(base, F.lit(suffix))).otherwise(base)
    return base


def _le(x: Column, nbytes: int) -> Column:
    h = F.lpad(F.hex(x.cast("long")), 2 * nbytes, "0")
    return F.concat(*[F.substring(h, 2 * i + 1, 2) for i in reversed(range(nbytes))])


def wav_bytes(n_samples: Column, rate: int = 16) -> Column:
    """16-bit mono PCM WAV of ``n_samples`` zero samples (a canonical 44-byte header)."""
    data = n_samples.cast("long") * 2
    header = F.concat(
        F.lit("52494646"), _le(data + 36, 4), F.lit("57415645"), F.lit("666D7420"),
        _le(F.lit(16), 4), _le(F.lit(1), 2), _le(F.lit(1), 2), _le(F.lit(rate), 4),
        _le(F.lit(rate * 2), 4), _le(F.lit(2), 2), _le(F.lit(16), 2),
        F.lit("64617461"), _le(data, 4))
    return F.unhex(F.concat(header, F.repeat(F.lit("0000"), n_samples.cast("int"))))
