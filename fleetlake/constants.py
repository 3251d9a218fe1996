"""Fixed values that results depend on."""

# Date a price takes effect, petrol, diesel, CNG (per litre).
FUEL_PRICE_TIMELINE = [
    ("2022-01-01", 144.82, 127.30, 115.00),
    ("2022-06-01", 179.86, 174.15, 135.00),
    ("2022-10-01", 224.80, 235.30, 160.00),
    ("2023-02-01", 249.80, 263.00, 175.00),
    ("2023-07-01", 290.45, 283.00, 190.00),
    ("2024-01-01", 279.75, 284.00, 195.00),
    ("2024-07-01", 268.42, 271.34, 185.00),
    ("2025-01-01", 255.63, 259.90, 180.00),
    ("2025-07-01", 249.50, 253.00, 175.00),
    ("2026-01-01", 243.80, 247.00, 170.00),
]

# Price used before the first timeline entry.
DEFAULT_FUEL_PRICE = 220.0

# Daily-rate multiplier per booking type.
BOOKING_MULTIPLIERS = {
    "City Ride": 1.00,
    "Airport Transfer": 1.10,
    "Intercity": 1.15,
    "Wedding": 1.25,
    "Corporate": 1.05,
    "Tourism / Northern Areas": 1.20,
    "Monthly Contract": 0.75,
    "Event": 1.20,
}

# Share of the monthly cost base per expense category.
EXPENSE_SHARES = {
    "Staff Salaries": 0.40,
    "Driver Salaries": 0.20,
    "Office Rent": 0.08,
    "Utilities": 0.02,
    "Marketing": 0.04,
    "Insurance Premium": 0.06,
    "Depreciation": 0.08,
    "Miscellaneous": 0.04,
    "Communication": 0.02,
    "Parking / Garage": 0.06,
}

# Driver behaviour profiles, best to worst.
PROFILES = ["excellent", "good", "average", "poor", "dangerous"]

# RFM segments in order, as (name, recency at least, frequency at least, recency below, frequency below); None is open.
RFM_SEGMENTS = [
    ("Champion", 4, 4, None, None),
    ("Loyal", 3, 3, None, None),
    ("New Customer", 4, None, None, 2),
    ("At Risk", None, 3, 2, None),
    ("Lost", None, None, 2, 2),
]
RFM_OTHER = "Potential"

# Weights of the composite driver risk.
RISK_WEIGHTS = {
    "lost safety": 0.35,
    "brakes per trip": 15,
    "accelerations per trip": 10,
    "mean idle minutes": 0.05,
    "speeding km per trip": 0.1,
    "accidents": 8,
    "complaints": 3,
}

# Upper bounds of the risk categories, and the one beyond.
RISK_CATEGORIES = [(20, "Low Risk"), (45, "Medium Risk"), (70, "High Risk")]
RISK_BEYOND = "Critical"

# Upper bounds in hours of the downtime categories, and the one beyond.
DOWNTIME_CATEGORIES = [(2, "Immediate"), (24, "Same Day"), (168, "Within Week")]
DOWNTIME_BEYOND = "Extended Downtime"

# Fuel burnt by an idling engine (litres per hour) and its price.
IDLE_LITRES_PER_HOUR = 0.5
IDLE_FUEL_PRICE = 260

# Invoice lines as charge type and description.
CHARGES = {
    "base": ("Base Rental Fare", "Base fare"),
    "airport": ("Surcharge", "Airport Pickup/Drop"),
    "night": ("Surcharge", "Night Surcharge"),
    "discount": ("Discount", "Promotional / Loyalty Discount"),
}

# KPI thresholds as (metric, good bound, warning bound, higher is better).
KPI_THRESHOLDS = [
    ("collection_rate", 92.0, 80.0, True),
    ("cancel_rate", 8.0, 15.0, False),
    ("safety_score", 70.0, 55.0, True),
    ("utilisation", 65.0, 45.0, True),
    ("fuel_efficiency", 12.0, 9.0, True),
    ("repeat_rate", 40.0, 0.0, True),
]

EARTH_RADIUS_KM = 6371.0
ROAD_FACTOR = 1.3
