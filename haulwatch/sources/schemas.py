"""Record layouts of the message topics."""

from __future__ import annotations

# Field names and order of the records that go over the topics.
POSITION = (
    "devid string, time string, lng double, lat double, point string, speed double, pos int, "
    "gpsflag int, wireflag int, powerflag int, accflag int, auxiliaryflag int, t string, door string, "
    "alldistance double, alldistfuel double, gpsdistance string, gpsalldistance double, "
    "createdatetime string, zxcqi string, alarmflag int, mainoilper string, residualoil string, "
    "viceoilper string, viceresidualoil string, oildifference string, sharpturn int, brake int"
)

BUS = POSITION + (
    ", vehicle_id long, car_card_number string, vehicle_model_id string, vehicle_type_id string, "
    "vehicle_type_state string, vehicle_state string, if_new_energy int, approved_tonnage float, "
    "driver_id long, enterprise_id string, dept_id int, audit_state string, manage_state string, "
    "driver_card_number string, driver_name string, enterprise_name string, department_id int, "
    "address string, enterprise_lng double, enterprise_lat double, enterprise_type_id string, "
    "province_id string, city_id string, area_id string, coords string, register_card_state int, "
    "transport_card_state int, service_state int, region_id string, region_name string, at_work int, "
    "mileage double"
)
