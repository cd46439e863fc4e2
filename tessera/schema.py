"""Column names, schemas and fixed values."""

from __future__ import annotations

# They must equal those that existing workbooks were made with.
INPUT_COLUMNS = ["No", "Provinsi SPPG", "Kab./Kota SPPG", "Kecamatan SPPG", "Kelurahan/Desa SPPG", "Alamat SPPG", "Nama SPPG"]
PROVINCE_GROUPS = {
    "sumatra": ["ACEH", "SUMATERA UTARA", "SUMATERA BARAT", "RIAU", "JAMBI", "SUMATERA SELATAN", "BENGKULU", "LAMPUNG", "KEPULAUAN RIAU", "KEPULAUAN BANGKA BELITUNG"],
    "java": ["BANTEN", "DKI JAKARTA", "JAKARTA", "JAWA BARAT", "JAWA TENGAH", "JAWA TIMUR", "DAERAH ISTIMEWA YOGYAKARTA", "YOGYAKARTA", "BALI"],
    "kalimantan": ["KALIMANTAN BARAT", "KALIMANTAN TENGAH", "KALIMANTAN SELATAN", "KALIMANTAN TIMUR", "KALIMANTAN UTARA"],
    "sulawesi": ["SULAWESI UTARA", "SULAWESI TENGAH", "SULAWESI SELATAN", "SULAWESI TENGGARA", "SULAWESI BARAT", "GORONTALO"],
    "nusa-tenggara": ["NUSA TENGGARA BARAT", "NUSA TENGGARA TIMUR"],
    "maluku": ["MALUKU", "MALUKU UTARA"],
    "papua": ["PAPUA", "PAPUA BARAT", "PAPUA BARAT DAYA", "PAPUA TENGAH", "PAPUA SELATAN", "PAPUA PEGUNUNGAN"],
}
PREFIX_TOKENS = ["JL", "JLN", "JALAN", "JALN", "JLAN", "GG", "GANG", "KOMP", "KOMPLEK", "KOMPLEKS", "PERUM", "PERUMAHAN", "BTN", "BLK", "BLOK", "RUKO", "RUKAN"]
TERMINATORS = ["NO", "NOMOR", "RT", "RW", "KEL", "KELURAHAN", "KEC", "KECAMATAN", "KAB", "KABUPATEN", "PROV", "PROVINSI", "DEPAN", "BELAKANG", "SAMPING", "SEBELAH", "DALAM", "LUAR", "LINGKUNGAN", "LINGK", "KM"]
NAMELESS_ROADS = ["", "UNNAMED ROAD", "NO NAME", "TANPA NAMA", "JALAN TANPA NAMA", "UNKNOWN"]
PROVINCE_WORDS = ["DAERAH KHUSUS IBUKOTA", "DAERAH ISTIMEWA", "PROVINSI", "PROV"]
ADMIN_WORDS = ["DAERAH ISTIMEWA", "DAERAH KHUSUS IBUKOTA", "PROVINSI", "KABUPATEN", "KAB", "KOTA ADMINISTRASI", "KOTA ADM", "KOTA", "KECAMATAN", "KEC", "KELURAHAN", "KEL", "DESA", "DS", "DSN"]
CITY_WORDS = ["ADMINISTRASI", "ADM"]
CITY_ALIASES = {"KEP SERIBU": "KEPULAUAN SERIBU", "KEPULAUAN SERIBU": "KEPULAUAN SERIBU", "SERIBU": "KEPULAUAN SERIBU"}
MAX_TOKENS, MIN_SCORE, MIN_MARGIN = 8, 0.82, 0.05
RELAXED_SCORE, RELAXED_MARGIN = 0.74, 0.03
NAME_SIMILARITY, CONTAINED_NAME, CONTAINED_ROAD = 0.75, 0.99, 0.98
EXACT_OVERLAP, OVERFLOW_CANDIDATES = 10_000, 100
ADMIN_LEVELS = {"province": [4], "kabkota": [5], "kecamatan": [6], "kelurahan": [7, 8, 9]}
DEFAULT_SEED = 20260507
LEVELS = ["kelurahan/desa", "kecamatan", "kabupaten/kota"]

#: Names that are easy to use in expressions, in the order of INPUT_COLUMNS.
SHORT_COLUMNS = ["no", "province", "kabkota", "kecamatan", "kelurahan", "address", "name"]
POINTS = "array<struct<x:double,y:double>>"
PARTS = f"array<{POINTS}>"
FACILITY = "source_row bigint, no bigint, province string, kabkota string, kecamatan string, kelurahan string, address string, name string"
ROADS = f"road_id bigint, name string, parts {PARTS}, minx double, miny double, maxx double, maxy double"
AREAS = f"province_name string, kabkota_name string, kecamatan_name string, kelurahan_name string, rings {PARTS}, minx double, miny double, maxx double, maxy double"
