"""Values that results depend on, gathered in one place."""

# --- fixed values: link ranking -------------------------------------------
RANK_BASE = 0.15
RANK_FACTOR = 0.85
RANK_START = 1.0
RANK_ITERATIONS = 10
NORMALISED_TELEPORT = 0.15
FIRST_LINES = 1000
LINK_PARTITIONS = 120
KEPT_NAMESPACE = "Category:"
COMMENT_PREFIX = "#"

# --- fixed values: ordered export -----------------------------------------
EXPORT_VIEW = "Table"
EXPORT_ORDER = ("cca2", "timestamp")

# --- fixed values: softmax training ---------------------------------------
FULL_BATCH_RATE = 0.05
FULL_BATCH_EPOCHS = 40

# --- fixed values: momentum settings ((pattern, start, target, stairs, momentum))
DECAYED_GROUPS = (
    ("weights", 0.001, 250.0, 4, 0.9),
    ("biases", 0.002, 10.0, 2, 0.9),
)
DEFAULT_RATE = 0.02
DEFAULT_MOMENTUM = 0.9
WEIGHT_DECAY = 0.0005
SAVE_EVERY = 100

# --- fixed values: image datasets -----------------------------------------
NUM_VALIDATION = 350
SPLIT_SEED = 0
NUM_SHARDS = 5
IMAGE_SIDE = 256
FLOWER_SPLITS = {"train": 3320, "validation": 350}
FLOWER_CLASSES = 5
FLOWER_PATTERN = "flowers_%s_*"
FLOWER_SHARD_NAME = "flowers_%s_%05d-of-%05d"
FLOWER_DEFAULTS = {"encoded": b"", "format": "png", "label": 0}
SYNSET_SPLITS = {"train": 1281167, "validation": 50000}
SYNSET_CLASSES = 1001
SYNSET_PATTERN = "%s-*"
SYNSET_DEFAULTS = {"encoded": b"", "format": "jpeg", "label": -1, "text": ""}
SYNSET_COUNT = 1000
SYNSET_NAME_COUNT = 21842
BACKGROUND_NAME = "background"
LABELS_FILE = "labels.txt"
SYNTHETIC_CLASSES = 1000
