"""Labels, codes and lists the source publishers use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

HOME_COUNTIES = ("King", "Kitsap", "Pierce", "Snohomish")

# Census variable code and label, by topic.
ACS_TOPICS = {
    "commute-modes": (
        ("B08301_001", "Total"),
        ("B08301_003", "Drove Alone"),
        ("B08301_004", "Carpooled"),
        ("B08301_010", "Transit"),
        ("B08301_016", "Other"),
        ("B08301_017", "Other"),
        ("B08301_018", "Bike"),
        ("B08301_019", "Walk"),
        ("B08301_020", "Other"),
        ("B08301_021", "Work from Home"),
    ),
    "commute-times": (
        ("B08303_001", "Total"),
        ("B08303_002", "Less than 15 minutes"),
        ("B08303_003", "Less than 15 minutes"),
        ("B08303_004", "15 to 30 minutes"),
        ("B08303_005", "15 to 30 minutes"),
        ("B08303_006", "15 to 30 minutes"),
        ("B08303_007", "15 to 30 minutes"),
        ("B08303_008", "30 to 45 minutes"),
        ("B08303_009", "30 to 45 minutes"),
        ("B08303_010", "30 to 45 minutes"),
        ("B08303_011", "45 to 60 minutes"),
        ("B08303_012", "more than 60 minutes"),
        ("B08303_013", "more than 60 minutes"),
    ),
    "departure-time": (
        ("B08011_001", "Total"),
        ("B08011_002", "Overnight"),
        ("B08011_003", "Early Morning"),
        ("B08011_004", "Early Morning"),
        ("B08011_005", "Early Morning"),
        ("B08011_006", "Early Morning"),
        ("B08011_007", "AM Peak"),
        ("B08011_008", "AM Peak"),
        ("B08011_009", "AM Peak"),
        ("B08011_010", "AM Peak"),
        ("B08011_011", "Late Morning"),
        ("B08011_012", "Late Morning"),
        ("B08011_013", "Late Morning"),
        ("B08011_014", "Afternoon"),
        ("B08011_015", "Evening"),
    ),
    "race-ethnicity": (
        ("B03002_001", "Total"),
        ("B03002_003", "White"),
        ("B03002_004", "Black"),
        ("B03002_005", "American Indian and Alaska Native"),
        ("B03002_006", "Asian"),
        ("B03002_007", "Native Hawaiian and Other Pacific Islander"),
        ("B03002_008", "Some Other Race"),
        ("B03002_009", "Two or More Races"),
        ("B03002_012", "Hispanic or Latinx"),
    ),
    "housing-tenure": (
        ("B25003_001", "Total"),
        ("B25003_002", "Own"),
        ("B25003_003", "Rent"),
    ),
    "educational-attainment": (
        ("B15002_001", "Total"),
        ("B15002_003", "No High School Diploma"),
        ("B15002_004", "No High School Diploma"),
        ("B15002_005", "No High School Diploma"),
        ("B15002_006", "No High School Diploma"),
        ("B15002_007", "No High School Diploma"),
        ("B15002_008", "No High School Diploma"),
        ("B15002_009", "No High School Diploma"),
        ("B15002_010", "No High School Diploma"),
        ("B15002_011", "High School Diploma"),
        ("B15002_012", "Some College"),
        ("B15002_013", "Some College"),
        ("B15002_014", "Associates Degree"),
        ("B15002_015", "Bachelors Degree"),
        ("B15002_016", "Masters Degree"),
        ("B15002_017", "Professional Degree"),
        ("B15002_018", "Doctorate Degree"),
        ("B15002_020", "No High School Diploma"),
        ("B15002_021", "No High School Diploma"),
        ("B15002_022", "No High School Diploma"),
        ("B15002_023", "No High School Diploma"),
        ("B15002_024", "No High School Diploma"),
        ("B15002_025", "No High School Diploma"),
        ("B15002_026", "No High School Diploma"),
        ("B15002_027", "No High School Diploma"),
        ("B15002_028", "High School Diploma"),
        ("B15002_029", "Some College"),
        ("B15002_030", "Some College"),
        ("B15002_031", "Associates Degree"),
        ("B15002_032", "Bachelors Degree"),
        ("B15002_033", "Masters Degree"),
        ("B15002_034", "Professional Degree"),
        ("B15002_035", "Doctorate Degree"),
    ),
    "age": (
        ("B01001_001", "Total"),
        ("B01001_003", "under 18"),
        ("B01001_004", "under 18"),
        ("B01001_005", "under 18"),
        ("B01001_006", "under 18"),
        ("B01001_007", "18 to 64"),
        ("B01001_008", "18 to 64"),
        ("B01001_009", "18 to 64"),
        ("B01001_010", "18 to 64"),
        ("B01001_011", "18 to 64"),
        ("B01001_012", "18 to 64"),
        ("B01001_013", "18 to 64"),
        ("B01001_014", "18 to 64"),
        ("B01001_015", "18 to 64"),
        ("B01001_016", "18 to 64"),
        ("B01001_017", "18 to 64"),
        ("B01001_018", "18 to 64"),
        ("B01001_019", "18 to 64"),
        ("B01001_020", "65 to 85"),
        ("B01001_021", "65 to 85"),
        ("B01001_022", "65 to 85"),
        ("B01001_023", "65 to 85"),
        ("B01001_024", "65 to 85"),
        ("B01001_025", "over 85"),
        ("B01001_027", "under 18"),
        ("B01001_028", "under 18"),
        ("B01001_029", "under 18"),
        ("B01001_030", "under 18"),
        ("B01001_031", "18 to 64"),
        ("B01001_032", "18 to 64"),
        ("B01001_033", "18 to 64"),
        ("B01001_034", "18 to 64"),
        ("B01001_035", "18 to 64"),
        ("B01001_036", "18 to 64"),
        ("B01001_037", "18 to 64"),
        ("B01001_038", "18 to 64"),
        ("B01001_039", "18 to 64"),
        ("B01001_040", "18 to 64"),
        ("B01001_041", "18 to 64"),
        ("B01001_042", "18 to 64"),
        ("B01001_043", "18 to 64"),
        ("B01001_044", "65 to 85"),
        ("B01001_045", "65 to 85"),
        ("B01001_046", "65 to 85"),
        ("B01001_047", "65 to 85"),
        ("B01001_048", "65 to 85"),
        ("B01001_049", "over 85"),
    ),
    "income": (
        ("B19001_001", "Total"),
        ("B19001_002", "under $50k"),
        ("B19001_003", "under $50k"),
        ("B19001_004", "under $50k"),
        ("B19001_005", "under $50k"),
        ("B19001_006", "under $50k"),
        ("B19001_007", "under $50k"),
        ("B19001_008", "under $50k"),
        ("B19001_009", "under $50k"),
        ("B19001_010", "under $50k"),
        ("B19001_011", "$50k to $75k"),
        ("B19001_012", "$50k to $75k"),
        ("B19001_013", "$75k to $100k"),
        ("B19001_014", "$100k to $150k"),
        ("B19001_015", "$100k to $150k"),
        ("B19001_016", "$150k to $200k"),
        ("B19001_017", "more than $200k"),
    ),
}

# Powertrain labels in the title file, in the order they are rewritten.
ENGINE_LABELS = (
    ("BEV (Battery Electric Vehicle)", "Battery Electric Vehicle"),
    ("HEV (Hybrid Electric Vehicle) - Level Unknown", "Hybrid Electric Vehicle"),
    ("ICE (Internal Combustion Engine)", "Internal Combustion Engine"),
    ("Mild HEV (Hybrid Electric Vehicle)", "Hybrid Electric Vehicle"),
    ("Strong HEV (Hybrid Electric Vehicle)", "Hybrid Electric Vehicle"),
    ("PHEV (Plug-in Hybrid Electric Vehicle)", "Plug-in Hybrid Electric Vehicle"),
)

# Registration count columns of the open-data feed: landed name, short name, label.
REGISTRATION_COUNTS = (
    ("battery_electric_vehicles_bevs_", "bev", "Battery Electric"),
    ("plug_in_hybrid_electric_vehicles_phevs_", "phev", "Plug-In Hybrid"),
    ("electric_vehicle_ev_total", "ev", "Total Electric Vehicles"),
    ("non_electric_vehicles", "non_ev", "Internal Combustion"),
    ("total_vehicles", "total_vehicles", "Total Vehicles"),
)

# Transit mode codes.
TRANSIT_MODES = {
    "AG": "Rail",
    "DR-DO": "Demand Response",
    "DR-PT": "Demand Response",
    "DR-TN": "Demand Response",
    "DR-TX": "Demand Response",
    "CB": "Bus",
    "CC": "Rail",
    "CR": "Commuter Rail",
    "FB": "Ferry",
    "HR": "Rail",
    "LR": "Rail",
    "MB": "Bus",
    "MG": "Rail",
    "MO": "Rail",
    "RB": "Bus",
    "SR": "Rail",
    "TB": "Bus",
    "TR": "Rail",
    "VP": "Vanpool",
    "YR": "Rail",
}
TRANSIT_METRICS = {"UPT": "Boardings", "VRM": "Revenue-Miles", "VRH": "Revenue-Hours"}
DEMAND_RESPONSE_SERVICES = ("DO", "PT", "TN", "TX")

# Airport summary rows: published category, metric, variable.
AIRPORT = "Seattle-Tacoma International Airport"
AIRPORT_CATEGORIES = (
    ("Subtotal - Domestic Passengers", "Passengers", "Domestic"),
    ("Subtotal - International Passengers", "Passengers", "International"),
    ("Subtotal - Domestic Air Freight", "Cargo", "Domestic"),
    ("Subtotal - International Air Freight", "Cargo", "International"),
    ("PASSENGER GRAND TOTAL", "Passengers", "Total"),
    ("CARGO GRAND TOTAL", "Cargo", "Total"),
)

# Monthly jobs: areas and industries.
JOB_AREAS = {
    "Washington State": "State",
    "Seattle MSA": "MSA",
    "Tacoma MSA": "MSA",
    "Bremerton MSA": "MSA",
    "Region": "Region",
}
PRIVATE_SERVICES = (
    "Trade, Transportation, and Utilities",
    "Information",
    "Financial Activities",
    "Professional and Business Services",
    "Educational and Health Services",
    "Leisure and Hospitality",
    "Other Services",
)

# Jurisdiction names and regional geography classes.
JURISDICTION_NAMES = (
    ("Seatac", "SeaTac"),
    ("Beau Arts Village", "Beaux Arts Village"),
    ("Uninc. King", "King County"),
    ("Uninc. Kitsap", "Kitsap County"),
    ("Uninc. Pierce", "Pierce County"),
    ("Uninc. Snohomish", "Snohomish County"),
)
REGIONAL_CLASSES = (
    ("HCT", "High Capacity Transit Community"),
    ("Metro", "Metropolitan Cities"),
    ("Core", "Core Cities"),
    ("CitiesTowns", "Cities & Towns"),
)

# Housing headers: text in the header, metric.
HOUSING_METRICS = (
    ("Total", "Housing Units"),
    ("One", "Single-Family"),
    ("Two", "Multi-Family"),
    ("Mobile", "Mobile Home"),
)


def acs_lookup(spark: SparkSession, topics=None) -> DataFrame:
    """Census variable code to label, one row per code, for the named topics (all if none)."""
    rows = [
        (topic, variable, label)
        for topic, labels in ACS_TOPICS.items()
        if topics is None or topic in topics
        for variable, label in labels
    ]
    return spark.createDataFrame(rows, "topic string, variable string, simple_label string")
