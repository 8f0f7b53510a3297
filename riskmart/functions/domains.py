"""Fixed values of the business model."""

# Risk and performance bands (lower bound inclusive, label).
SUPPLIER_BANDS = [(75, "Critical"), (50, "High"), (25, "Medium")]
SUPPLIER_FLOOR = "Low"
INVENTORY_BANDS = [(80, "Critical"), (60, "High"), (30, "Medium")]
INVENTORY_FLOOR = "Low"
CARRIER_BANDS = [(75, "Excellent"), (50, "Good"), (25, "Average")]
CARRIER_FLOOR = "Poor"
RATING_BANDS = [(94, "Low"), (86, "Medium"), (75, "High")]
RATING_FLOOR = "Critical"
INSPECTION_BANDS = [(95, "Passed"), (85, "Conditional")]
INSPECTION_FLOOR = "Failed"

# Order in which distribution reports list the labels.
SUPPLIER_ORDER = ["Critical", "High", "Medium", "Low"]
CARRIER_ORDER = ["Excellent", "Good", "Average", "Poor"]

# Score weights.
SUPPLIER_WEIGHTS = [
    ("LateDeliveryRiskScore", "0.40"),
    ("DelaySeverityRiskScore", "0.20"),
    ("QualityRiskScore", "0.25"),
    ("DependencyRiskScore", "0.15"),
]
DEPENDENCY_WEIGHTS = [
    ("PurchaseExposureScore", "0.40"),
    ("ProductExposureScore", "0.25"),
    ("WarehouseExposureScore", "0.20"),
    ("ProductConcentrationScore", "0.15"),
]
CARRIER_WEIGHTS = [
    ("DeliveryPerformanceScore", "0.50"),
    ("CostEfficiencyScore", "0.30"),
    ("DamagePerformanceScore", "0.20"),
]

# Base score per stock status; every other status scores 10.
STOCK_BASE_SCORES = [
    ("Stockout", 100),
    ("Critical", 85),
    ("Reorder Required", 65),
    ("Overstock", 45),
]
STOCK_BASE_OTHER = 10

# Accepted report parameters.
RISK_LEVELS = ["Low", "Medium", "High", "Critical"]
STOCK_STATUSES = ["Stockout", "Critical", "Reorder Required", "Overstock", "Safe"]
STOCK_AT_RISK = ["Stockout", "Critical", "Reorder Required"]

# The countries a supplier may have.
COUNTRIES = [
    "China", "India", "Bangladesh", "Vietnam", "Japan", "South Korea", "Singapore", "Malaysia",
    "Thailand", "Indonesia", "Germany", "France", "Italy", "Netherlands", "Poland", "Spain",
    "United Kingdom", "United States", "Canada", "Mexico", "Brazil", "Argentina", "UAE",
    "Saudi Arabia", "Turkey", "South Africa", "Egypt", "Australia",
]

# Supplier categories that can serve a product category.
CATEGORY_MAP = {
    "Industrial Equipment": ["Industrial Equipment", "Mechanical Components"],
    "Electronic Components": ["Electronic Components", "Electrical Components"],
    "Mechanical Components": ["Mechanical Components", "Raw Materials"],
    "Electrical Components": ["Electrical Components", "Electronic Components"],
    "Raw Materials": ["Raw Materials", "Chemicals"],
    "Packaging": ["Packaging", "Raw Materials"],
}

# Calendar covered by the date dimension, and the stock snapshots.
CALENDAR = ("2022-01-01", "2026-12-31")
SNAPSHOTS = ("2022-01-31", "2026-09-30")
