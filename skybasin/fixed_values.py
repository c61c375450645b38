"""Fixed values.

Constants of the data model that outside producers, stored tables and
dashboards rely on.  They are data, stated once here in their natural order.
"""

# --- Regions: name, latitude, longitude, weather lookup name -------------------
PROVINCES = [
    ("Bangkok", 13.7563, 100.5018, "Bangkok"),
    ("ChiangMai", 18.7883, 98.9853, "Chiang Mai"),
    ("Phuket", 7.8804, 98.3923, "Phuket"),
    ("KhonKaen", 16.4322, 102.8236, "Khon Kaen"),
    ("Chon Buri", 12.9236, 100.8825, "Pattaya"),
]
COUNTRY = "Thailand"

PROVINCE_ALIASES = [("Pattaya", "Chon Buri")]

THAI_NAMES = [
    ("กรุงเทพมหานคร", "Bangkok"),
    ("เชียงใหม่", "ChiangMai"),
    ("ขอนแก่น", "KhonKaen"),
    ("ภูเก็ต", "Phuket"),
    ("พัทยา (ชลบุรี)", "Chon Buri"),
]

# --- Sources, topics and tables ------------------------------------------------
SOURCES = ("air_quality", "weather", "flood")
TOPICS = {
    "air_quality": "air_quality_raw",
    "weather": "weather_raw",
    "flood": "flood_raw",
}
BRONZE = {
    "air_quality": "bronze_air_quality",
    "weather": "bronze_weather",
    "flood": "bronze_flood",
}
SILVER = {
    "air_quality": "silver_air_quality",
    "weather": "silver_weather",
    "flood": "silver_flood",
    "joined": "silver_environmental_joined",
}
FACT = "fact_environmental"
DIM_LOCATION = "dim_location"
DIM_TIME = "dim_time"

# --- Defaults and stamps -------------------------------------------------------
DEFAULT_UNIT = "µg/m³"
UNKNOWN_SOURCE = "unknown"
AIR_API_SOURCE = "openaq_custom"
WEATHER_API_SOURCE = "openweather"
SEEDED_SILVER = "json_export"
SEEDED_GOLD = "silver_environmental_joined"

# --- Validation limits ---------------------------------------------------------
PM25_MIN = 0
TEMPERATURE_RANGE = (-10, 60)
FLOOD_LEVELS = ("Low", "Medium", "High", "Very High")

# --- Scores: (upper bound inclusive, score), then the score above the last bound
PM25_SCORES = [(25, 10), (50, 30), (100, 60), (150, 80)]
PM25_SCORE_ABOVE = 100
TEMPERATURE_EXTREME = (20, 40, 80)  # below, above, score
TEMPERATURE_SCORES = [(25, 20), (30, 40), (35, 60)]
TEMPERATURE_SCORE_ABOVE = 75
FLOOD_SCORES = {"Low": 20, "Medium": 50, "High": 80, "Very High": 100}
RISK_WEIGHTS = (0.5, 0.2, 0.3)  # pm25, temperature, flood
RISK_LEVELS = [(30, "Low"), (60, "Moderate"), (80, "High")]
RISK_LEVEL_ABOVE = "Critical"

# --- Labels --------------------------------------------------------------------
PM25_CATEGORIES = [
    (25, "Good"),
    (37, "Moderate"),
    (50, "Unhealthy for Sensitive Groups"),
    (90, "Unhealthy"),
]
PM25_CATEGORY_ABOVE = "Very Unhealthy"
HUMIDITY_BOUNDS = (40, 70)
RAIN_WORDS = ("rain", "drizzle", "thunderstorm", "shower")
CLEAR_WORDS = ("clear", "sunny", "hot")
CLOUD_WORDS = ("cloud", "overcast", "mist", "fog", "haze")
UNKNOWN = "Unknown"

# --- Heat index: coefficient, power of temperature, power of humidity ----------
HEAT_MIN_TEMPERATURE = 27
HEAT_MIN_HUMIDITY = 40
HEAT_TERMS = [
    (-8.78469475556, 0, 0),
    (1.61139411, 1, 0),
    (2.33854883889, 0, 1),
    (-0.14611605, 1, 1),
    (-0.012308094, 2, 0),
    (-0.0164248277778, 0, 2),
    (0.002211732, 2, 1),
    (0.00072546, 1, 2),
    (-0.000003582, 2, 2),
]

# --- Alerts --------------------------------------------------------------------
ALERT_THRESHOLD = 50
ALERT_FLOOD_LEVELS = ("High", "Very High")
LEVEL_COLORS = {
    "Critical": "#d32f2f",
    "High": "#f57c00",
    "Moderate": "#fbc02d",
    "Low": "#388e3c",
    "Very High": "#d32f2f",
    "Medium": "#fbc02d",
}
OTHER_COLOR = "#000"
NOT_AVAILABLE = "N/A"

# --- Dashboard captions --------------------------------------------------------
IMPACT_CAPTION = "Avg PM2.5 by Weather Impact"
RAINY_CAPTION = "Avg PM2.5 Rainy vs Non-Rainy"

# --- Characters that count as blank space at the ends of a name ----------------
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
