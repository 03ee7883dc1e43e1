"""Sub-value parsers on contents as editions write them."""

import pytest

from yearloom.functions import subvalues as S

CASES = [
    (S.area, "total: 52,300 sq km | land: 50,110 sq km | water: 2,190 sq km", {"total": 52300, "land": 50110, "water": 2190}),
    (S.area, "total: | 8,204 sq km | land: | 8,000 sq km | water: | 204 sq km", {"total": 8204, "land": 8000, "water": 204}),
    (S.population, "total: 4,120,355 (2031 est.) male: 2,051,200 female: 2,069,155", {"total": 4120355, "male": 2051200, "female": 2069155}),
    (S.population, "7,345,012 (May 1987), growth rate 1.9% (1987)", {"total": 7345012, "growth_rate": 1.9}),
    (S.life_expectancy, "total population: 71.4 years (2031 est.) male: 69.2 years female: 73.9 years", {"total_population": 71.4, "male": 69.2, "female": 73.9}),
    (S.life_expectancy, "64 years male, 68 years female (1987)", {"male": 64, "female": 68, "total_population": 66}),
    (S.age_structure, "0-14 years: 27.3% (male 560,114/female 548,902)", {"0-14 years_pct": 27.3, "0-14 years_male": 560114, "0-14 years_female": 548902}),
    (S.dollars, "$61.5 billion (2031 est.) $58.25 billion (2030 est.)", {"value_2031": 6.15e10, "value_2030": 5.825e10}),
    (S.share_of_gdp, "1.45% of GDP (2031 est.) 1.6% of GDP (2030 est.)", {"pct_gdp_2031": 1.45, "pct_gdp_2030": 1.6}),
    (S.budget, "revenues: $12.4 billion expenditures: $13.05 billion", {"revenues": 1.24e10, "expenditures": 1.305e10}),
    (S.land_use, "agricultural land: 38.4% arable land: 11.7%", {"agricultural_land": 38.4, "arable_land": 11.7}),
    (S.electricity, "2,450,000 kW capacity; 9,800 million kWh produced, 1,334 kWh per capita", {"installed_generating_capacity": 2.45e6, "production": 9.8e9}),
    (S.coordinates, "12 30 S, 45 15 E", {"latitude": -12.5, "longitude": 45.25}),
    (S.elevation, "highest point: Mount Amber 2,876 m", {"highest": 2876}),
    (S.single_rate, "23.4 births/1,000 population (2031 est.)", {"value": 23.4}),
    (S.infant_mortality, "41 deaths per 1,000 live births (1987)", {"total": 41}),
    (S.single_value, "2.85 children born/woman (2031 est.)", {"value": 2.85}),
    (S.trade, "$3.4 billion (2031 est.) commodities: salt, amber partners: Upland 31%, Lowland 12.5%", {"value_2031": 3.4e9, "commodities": None, "partners": None, "partner_Upland": 31, "partner_Lowland": 12.5}),
    (S.dependency_ratios, "total dependency ratio: 61.2 youth dependency ratio: 48.7", {"total": 61.2, "youth": 48.7}),
    (S.urbanization, "urban population: 44.6% of total population rate of urbanization: 2.15% annual rate of change", {"urban_population": 44.6, "rate_of_urbanization": 2.15}),
    (S.with_units, "1,085 km", {"value": 1085}),
    (S.median_age, "total: 24.6 years male: 24.1 years female: 25.2 years", {"total": 24.6, "male": 24.1, "female": 25.2}),
    (S.sex_ratio, "at birth: 1.03 male(s)/female 0-14 years: 1.02 male(s)/female", {"at_birth": 1.03, "0-14_years": 1.02}),
    (S.literacy, "total population: 66.1% male: 72.8% female: 59.3%", {"total_population": 66.1, "male": 72.8, "female": 59.3}),
    (S.maritime_claims, "territorial sea: 10 nm exclusive economic zone: 150 nm", {"territorial_sea": 10, "exclusive_economic_zone": 150}),
    (S.natural_gas, "production: 2.36 billion cubic meters", {"production": 2.36e9}),
    (S.internet_users, "total: 1.9 million percent of population: 46%", {"total": 1.9e6, "percent_of_population": 46}),
    (S.telephones, "total subscriptions: 402118", {"total_subscriptions": 402118}),
    (S.gdp_composition, "agriculture: 21.4% industry: 30.2% services: 48.4%", {"agriculture": 21.4, "industry": 30.2, "services": 48.4}),
    (S.household_income, "lowest 10%: 2.3% highest 10%: 33.1%", {"lowest_10pct": 2.3, "highest_10pct": 33.1}),
    (S.school_life, "total: 11 years male: 12 years female: 10 years", {"total": 11, "male": 12, "female": 10}),
    (S.youth_unemployment, "total: 18.7% male: 17.3% female: 20.5%", {"total": 18.7, "male": 17.3, "female": 20.5}),
    (S.co2, "7.3 million metric tonnes of CO2", {"total": 7.3e6}),
    (S.water_withdrawal, "total: 4.7 cu km/yr (11%/4%/85%)", {"total": 4.7e9, "domestic_pct": 11, "industrial_pct": 4, "agricultural_pct": 85}),
    (S.broadband, "total: 310,400 subscriptions per 100 inhabitants: 7", {"total": 310400, "subscriptions_per_100": 7}),
    (S.water_source, "improved: urban: 88.5% of population rural: 61% of population unimproved: total: 26.3% of population", {"improved_urban": 88.5, "improved_rural": 61, "unimproved_total": 26.3}),
    (S.water_source, "urban: 91% of population rural: 55% of population total: 70% of population", {"improved_urban": 91, "improved_rural": 55, "improved_total": 70}),
    (S.waste, "percent of municipal solid waste recycled: 6.4% (2029 est.)", {"percent_recycled": 6.4}),
    (S.forest_revenue, "1.27% of GDP (2029 est.)", {"value": 1.27}),
    (S.generic, "length: 7.25 km | cost: $9 million | share: 13%", {"length": 7.25, "cost": 9e6, "share": 13}),
    (S.percents, "4.5.6% (2029 est.)", {"value": None}),
]


@pytest.mark.parametrize("parser,content,want", CASES)
def test_parser(spark, parser, content, want):
    df = spark.createDataFrame([(1, content)], "id long, content string")
    got = {r["sub_field"]: r["numeric_val"] for r in S.parsed(df, "content", parser).first()["sub_values"]}
    assert got == {k: v if v is None else pytest.approx(v) for k, v in want.items()}


def test_male_after_female(spark):
    text = "total population: 70.35 years | female: 73.15 years (2029 est.) | male: 67.55 years"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id long, content string")
    for strict, want in ((False, 73.15), (True, 67.55)):
        got = {r["id"]: r["sub_values"] for r in S.parsed(df, "content", S.life_expectancy, strict).collect()}
        assert {r["sub_field"]: r["numeric_val"] for r in got[1]}["male"] == want and got[2] is None and got[3] is None
