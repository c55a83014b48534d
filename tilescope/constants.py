"""Fixed values.

These must equal the values of the analyses this library reproduces, or the
results differ.  They are stated plainly and kept together here; the
operators take them as defaults.
"""

from datetime import timedelta

# --- fixed values -----------------------------------------------------------
SESSION_GAP = timedelta(minutes=15)  # a longer pause between events ends a session
BLOCK_SIZE = 100  # heat-map blocks are 100 x 100 positions
HISTOGRAM_CAP = 6  # placements-per-user bins: 1, 2, 3, 4, 5, "6+"
TOP_BLOCKS = 20  # block ranking length
TOP_INTENSITY_BLOCKS = 10  # placements-per-user ranking length
TOP_POINTS = 10  # most used points
TOP_CATEGORIES_PER_POINT = 3  # categories listed per point
LABEL_UNITS = ((1_000_000, "M"), (1_000, "K"))  # count labels: millions, thousands
LABEL_SIGNIFICANT_DIGITS = 4  # count labels keep at most 4 significant digits
LABEL_MAX_DECIMALS = 2  # and at most 2 decimals
RATIO_DECIMALS = 2  # placements per user printed with 2 decimals
SHARE_DECIMALS = 1  # histogram bar annotation: percentage with 1 decimal
PERCENT_DECIMALS = 2  # colour share percentages rounded to 2 decimals
PARQUET_COMPRESSION = "zstd"  # compacted table codec
ROW_GROUP_ROWS = 100_000  # compacted table row-group size
RAW_TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"  # raw log time text, followed by " UTC"
RAW_TIME_SUFFIX = " UTC"
RAW_TIME_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,6})?( UTC)?$"
HOUR_ARGUMENT_FORMAT = "%Y-%m-%d %H"  # time-range arguments are given to the hour
# ----------------------------------------------------------------------------
