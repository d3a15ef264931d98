"""verso: corpus building and text classification as Spark jobs.

Every public function takes DataFrames (or Columns) and returns DataFrames
(or Columns). Nothing is collected to the driver except the two lists whose
size a parameter bounds: the vocabulary (``vocab_size`` terms) and the label
list (number of classes).

The names below are the main entry points; the sub-packages hold the rest.
"""

__version__ = "0.1.0"

from verso.functions.text import clean_lyrics, first_year, reject_reason, year_with_fallback  # noqa: E402
from verso.operators.corpus import cap_at_target, dedup_first, top_per_group  # noqa: E402
from verso.operators.evaluate import classification_metrics, confusion_counts  # noqa: E402
from verso.operators.features import TfIdf, Vocabulary, term_stats, vocabulary  # noqa: E402
from verso.operators.model import ForestSettings, build_pipeline, fit_classifier, tune_classifier  # noqa: E402
from verso.operators.prepare import hash_split, prepare_rows, prepare_text_rows  # noqa: E402
from verso.operators.score import score, score_json  # noqa: E402
from verso.plans.corpus import build_corpus  # noqa: E402
from verso.sources.csv import read_songs_csv, write_songs_csv  # noqa: E402
from verso.sources.models import load_model, model_labels, save_model  # noqa: E402
from verso.sources.payload import payload_records  # noqa: E402
from verso.streaming.score_stream import start_score_stream  # noqa: E402

__all__ = [
    "clean_lyrics", "first_year", "reject_reason", "year_with_fallback",
    "cap_at_target", "dedup_first", "top_per_group",
    "classification_metrics", "confusion_counts",
    "TfIdf", "Vocabulary", "term_stats", "vocabulary",
    "ForestSettings", "build_pipeline", "fit_classifier", "tune_classifier",
    "hash_split", "prepare_rows", "prepare_text_rows",
    "score", "score_json", "build_corpus",
    "read_songs_csv", "write_songs_csv", "load_model", "model_labels", "save_model",
    "payload_records", "start_score_stream",
]
