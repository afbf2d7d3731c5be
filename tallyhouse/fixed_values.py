"""Fixed values of the business: stores, thresholds, catalog, recipes, name mapping.

They are defaults; every function that uses one takes it as a parameter.
"""

# Stores as (id, name, borough), and what all stores share.
STORES = (
    (3, "Astoria", "Queens"),
    (5, "Lower Manhattan", "Manhattan"),
    (8, "Hell's Kitchen", "Manhattan"),
)
STORE_CITY = "New York"
STORE_OPEN_DATE = "2019-01-01"

# The calendar, end not included.
CALENDAR_START = "2023-01-01"
CALENDAR_STOP = "2023-07-01"

# Class limits.
MARGIN_HIGH, MARGIN_MEDIUM = "0.70", "0.55"
LABOR_OVER, LABOR_WATCH = 35, 30
STOCK_HIGH_RISK, STOCK_MEDIUM_RISK = 2, 4
TRAILING_RECORDS = 7

# Categories that need neither a cost nor a recipe when a mapping is suggested.
NO_RECIPE_CATEGORIES = ("Branded", "Coffee beans", "Packaged Chocolate", "Loose Tea")

# Products as (name, category, share of cost in price).
PRODUCTS = (
    ("Drip coffee", "Coffee", 0.22),
    ("Gourmet brewed coffee", "Coffee", 0.22),
    ("Barista Espresso", "Coffee", 0.20),
    ("Latte", "Coffee", 0.32),
    ("Cappuccino", "Coffee", 0.30),
    ("Cortado", "Coffee", 0.28),
    ("Americano", "Coffee", 0.18),
    ("Espresso shot", "Coffee", 0.18),
    ("Brewed Chai tea", "Tea", 0.28),
    ("Brewed Black tea", "Tea", 0.25),
    ("Brewed herbal tea", "Tea", 0.30),
    ("Green tea", "Tea", 0.26),
    ("Morning Sunrise Chai", "Tea", 0.29),
    ("Traditional Blend Chai", "Tea", 0.29),
    ("Spicy Eye Opener Chai", "Tea", 0.30),
    ("Serenity Green Tea", "Tea", 0.26),
    ("English Breakfast", "Tea", 0.25),
    ("Lemon Grass", "Tea", 0.27),
    ("Peppermint", "Tea", 0.26),
    ("Croissant", "Bakery", 0.45),
    ("Almond Croissant", "Bakery", 0.47),
    ("Chocolate Croissant", "Bakery", 0.48),
    ("Scone", "Bakery", 0.42),
    ("Ginger Scone", "Bakery", 0.43),
    ("Cranberry Scone", "Bakery", 0.44),
    ("Jumbo Savory Scone", "Bakery", 0.46),
    ("Scottish Cream Scone", "Bakery", 0.43),
    ("Oatmeal Scone", "Bakery", 0.44),
    ("Muffin", "Bakery", 0.48),
    ("Hazelnut Biscotti", "Bakery", 0.41),
    ("Chocolate Chip Biscotti", "Bakery", 0.43),
    ("Ginger Biscotti", "Bakery", 0.41),
    ("Hot chocolate", "Drinking Chocolate", 0.35),
    ("Dark chocolate", "Drinking Chocolate", 0.36),
    ("Sugar Free Vanilla syrup", "Flavours", 0.14),
    ("Chocolate syrup", "Flavours", 0.16),
    ("Carmel syrup", "Flavours", 0.14),
    ("Hazelnut syrup", "Flavours", 0.14),
    ("Our Old Time Diner Blend", "Coffee", 0.22),
    ("Columbian Medium Roast", "Coffee", 0.22),
    ("Sustainably Grown Organic", "Coffee", 0.24),
    ("Jamaican Coffee River", "Coffee", 0.24),
    ("Brazilian", "Coffee", 0.23),
    ("Ethiopia", "Coffee", 0.23),
    ("Brazilian - Organic", "Coffee", 0.25),
    ("Organic Decaf Blend", "Coffee", 0.23),
    ("Ouro Brasileiro shot", "Coffee", 0.19),
    ("Civet Cat", "Coffee beans", 0.26),
    ("Espresso Roast", "Coffee beans", 0.24),
    ("Primo Espresso Roast", "Coffee beans", 0.24),
    ("Guatemalan Sustainably Grown", "Coffee beans", 0.25),
    ("Chili Mayan", "Packaged Chocolate", 0.28),
    ("Earl Grey", "Loose Tea", 0.25),
)

# Ingredients as (name, unit, cost per unit).
INGREDIENTS = (
    ("espresso_shot_ml", "ml", 0.008),
    ("whole_milk_ml", "ml", 0.002),
    ("oat_milk_ml", "ml", 0.004),
    ("coffee_grounds_g", "g", 0.015),
    ("tea_leaves_g", "g", 0.010),
    ("chocolate_syrup_ml", "ml", 0.006),
    ("flavor_syrup_ml", "ml", 0.005),
    ("sugar_g", "g", 0.001),
    ("flour_g", "g", 0.002),
    ("butter_g", "g", 0.005),
)

# Recipes as product -> ingredient amounts per unit sold.
RECIPES = {
    "Latte": {"espresso_shot_ml": 60, "whole_milk_ml": 180},
    "Cappuccino": {"espresso_shot_ml": 60, "whole_milk_ml": 120},
    "Cortado": {"espresso_shot_ml": 60, "whole_milk_ml": 60},
    "Americano": {"espresso_shot_ml": 60},
    "Espresso shot": {"espresso_shot_ml": 30},
    "Barista Espresso": {"espresso_shot_ml": 30},
    "Drip coffee": {"coffee_grounds_g": 18},
    "Gourmet brewed coffee": {"coffee_grounds_g": 18},
    "Brewed Chai tea": {"tea_leaves_g": 5, "whole_milk_ml": 120},
    "Brewed Black tea": {"tea_leaves_g": 3},
    "Brewed herbal tea": {"tea_leaves_g": 4},
    "Green tea": {"tea_leaves_g": 3},
    "Morning Sunrise Chai": {"tea_leaves_g": 5, "whole_milk_ml": 120},
    "Traditional Blend Chai": {"tea_leaves_g": 5, "whole_milk_ml": 120},
    "Spicy Eye Opener Chai": {"tea_leaves_g": 5, "whole_milk_ml": 120},
    "Serenity Green Tea": {"tea_leaves_g": 3},
    "English Breakfast": {"tea_leaves_g": 3},
    "Lemon Grass": {"tea_leaves_g": 4},
    "Peppermint": {"tea_leaves_g": 4},
    "Hot chocolate": {"chocolate_syrup_ml": 45, "whole_milk_ml": 180},
    "Dark chocolate": {"chocolate_syrup_ml": 45, "whole_milk_ml": 180},
    "Sugar Free Vanilla syrup": {"flavor_syrup_ml": 30},
    "Chocolate syrup": {"chocolate_syrup_ml": 30},
    "Carmel syrup": {"flavor_syrup_ml": 30},
    "Hazelnut syrup": {"flavor_syrup_ml": 30},
    "Our Old Time Diner Blend": {"coffee_grounds_g": 18},
    "Columbian Medium Roast": {"coffee_grounds_g": 18},
    "Sustainably Grown Organic": {"coffee_grounds_g": 18},
    "Jamaican Coffee River": {"coffee_grounds_g": 18},
    "Brazilian": {"coffee_grounds_g": 18},
    "Ethiopia": {"coffee_grounds_g": 18},
    "Brazilian - Organic": {"coffee_grounds_g": 18},
    "Organic Decaf Blend": {"coffee_grounds_g": 18},
    "Ouro Brasileiro shot": {"espresso_shot_ml": 30},
    "Croissant": {"flour_g": 80, "butter_g": 30},
    "Almond Croissant": {"flour_g": 85, "butter_g": 35, "sugar_g": 10},
    "Chocolate Croissant": {"flour_g": 85, "butter_g": 35, "sugar_g": 10, "chocolate_syrup_ml": 12},
    "Scone": {"flour_g": 60, "butter_g": 20, "sugar_g": 15},
    "Ginger Scone": {"flour_g": 60, "butter_g": 20, "sugar_g": 18},
    "Cranberry Scone": {"flour_g": 62, "butter_g": 20, "sugar_g": 18},
    "Jumbo Savory Scone": {"flour_g": 85, "butter_g": 25, "sugar_g": 8},
    "Scottish Cream Scone": {"flour_g": 65, "butter_g": 22, "sugar_g": 15},
    "Oatmeal Scone": {"flour_g": 60, "butter_g": 20, "sugar_g": 15},
    "Muffin": {"flour_g": 70, "butter_g": 25, "sugar_g": 20},
    "Hazelnut Biscotti": {"flour_g": 45, "butter_g": 10, "sugar_g": 12},
    "Chocolate Chip Biscotti": {"flour_g": 45, "butter_g": 10, "sugar_g": 12, "chocolate_syrup_ml": 10},
    "Ginger Biscotti": {"flour_g": 45, "butter_g": 10, "sugar_g": 12},
}

# Shifts as (type, hours, start, end, employees, hourly rate, one more at the weekend).
SHIFTS = (
    ("morning", 4, "06:00", "10:00", 3, 15.0, True),
    ("midday", 4, "10:00", "14:00", 4, 15.0, True),
    ("afternoon", 4, "14:00", "18:00", 2, 15.5, False),
    ("closing", 3, "18:00", "21:00", 2, 15.5, False),
)

# Promotions, in the column order of the dataset.
PROMOTIONS = (
    ("PROMO_001", "Happy Hour Coffee", "percentage", 0.20, "Coffee", "2023-02-01", "2023-02-28",
     "Mon,Tue,Wed,Thu,Fri", "14:00-17:00", "CRM_LOYALTY"),
    ("PROMO_002", "Weekend Bakery Special", "percentage", 0.15, "Bakery", "2023-03-01", "2023-03-31",
     "Sat,Sun", "08:00-12:00", "CRM_LOYALTY"),
    ("PROMO_003", "Tea Tuesday", "fixed", 1.00, "Tea", "2023-04-01", "2023-06-30",
     "Tue", "all_day", "CRM_LOYALTY"),
)
