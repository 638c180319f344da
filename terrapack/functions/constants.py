"""Values that the file format and the rules fix."""

# Earth and projection.
EARTH_RADIUS = 6_378_137.0
MAX_LATITUDE = 85.0511287798066

# Fixed values of the layer file.
MAGIC = b"PMTF"
VERSION = (1, 0)
FIXED_HEADER, LEVEL_RECORD, INDEX_ENTRY, PAGE_ENTRIES, PAGE_BYTES = 64, 48, 16, 256, 4096
MOST_HEADER, MOST_FILE, MOST_TILE = 16 << 20, (1 << 31) - 1, 8 << 20
MOST_LEVELS, MOST_FEATURES, MOST_PARTS, MOST_POINTS = 8, 65_535, 65_535, 1 << 20
MOST_TILE_ZOOM, MOST_DISPLAY_ZOOM = 16, 22
NO_STRING = 0xFFFF
GRID_ZOOM, GRID_SIDE, GRID_BYTES = 8, 256, 16_384
POLYGON, LINE = 1, 2
BASE, WATER, ZONES = 1, 2, 3
ID_FIELDS = ("layer", "credit", "license", "source", "source_date", "build")

# Attribute tags and flags of zones.
NAME, SPEED, MONTHS, DAYS, FLAGS, SOURCE = 1, 2, 3, 4, 5, 6
CHANNEL, PARTIAL = 1, 2
ALL_YEAR, WEEKEND = 0xFFF, 0b1100000
MONTH_NAMES = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
#: Last day that counts as the end of the month.
MONTH_ENDS = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
DKMH_PER_MPH = 16.09344

# Levels as tile zoom, least and most display zoom, coordinate bits, buffer, tolerance in metres.
WATER_LEVELS = ((10, 10, 11, 12, 32, 40.0), (12, 12, 13, 12, 32, 10.0), (12, 14, 16, 16, 512, 4.0))
ZONE_LEVELS = ((10, 10, 11, 12, 32, 10.0), (12, 12, 16, 16, 512, 1.0))
OVERVIEW_LEVELS = ((2, 2, 4, 12, 32, 2000.0), (5, 5, 7, 12, 32, 300.0), (7, 8, 9, 12, 32, 80.0))
#: Size estimate: tolerance in metres and units of a zoom-12 tile.
ESTIMATE_LEVELS = ((40.0, 1024), (10.0, 4096), (4.0, 65_536))

REGION_ZOOM, REGION_MARGIN = 7, 0.05
LEAST_AREA = 10_000.0
MOST_PACK_BYTES = 2_000_000_000
#: South, west, north, east of the overview.
OVERVIEW_BOX = (5.0, -180.0, 84.0, -50.0)
